"""The registered queries: SQL twins, brute-force twins on whole small tables, and edge tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from conftest import SF_MID, SF_SMALL
from oracle import compare, duck
from tabflow.llm import queries as Q

import sys
sys.path.insert(0, __file__.rsplit("/", 1)[0])
from llm_tables import ODD_DOCS, ODD_ITEMS, ODD_LABELS, ODD_PAGES, VECTORS, odd_vectors, rows_of, write_tables  # noqa: E402

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def run(spark, name, sf=SF_SMALL):
    full = next(q for q in Q.QUERIES if q.startswith(name + "_"))
    return Q.QUERIES[full](spark, sf)


@pytest.fixture(scope="module")
def docs():
    return rows_of(SF_SMALL, "select doc_id, coalesce(text, '') t, source from documents order by doc_id")


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in Q.QUERIES if q.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql_twin(spark, name):
    if name == "pipeline":
        pytest.skip("no SQL twin")
    r = compare(Q.QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), Q.ORACLE[name])
    assert r["ok"], r


def suffix_brute(docs, length=100):
    seen, out = set(), {}
    for d, x, *_ in docs:
        b = x.encode()
        gone, end = bytearray(len(b)), -1
        for p in range(len(b)):
            if p + length <= len(b):
                w = b[p:p + length]
                if w in seen:
                    end = p + length
                seen.add(w)
            gone[p] = p < end
        runs = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


def test_op1_equals_brute_force(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in run(spark, "op1").collect()}
    assert got == suffix_brute(docs)


def test_op2_targets_and_bounds(spark, docs):
    rows = run(spark, "op2", SF_MID).collect()
    docs = rows_of(SF_MID, "select doc_id, coalesce(text, '') t, source from documents")
    size = {d: len(SPACE.findall(t)) for d, t, _ in docs}
    source = {d: s for d, _, s in docs}
    total = defaultdict(int)
    for d, n in size.items():
        total[source[d]] += n
    order = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    budget = 1.5 * sum(total.values())
    while open_:  # the excess above the caps is shared again by weight
        left = budget - sum(target.values())
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * unit > 2 * total[s]}
        if not over:
            target |= {s: weight[s] * unit for s in open_}
            break
        target |= {s: 2.0 * total[s] for s in over}
        open_ -= over
    taken = Counter()
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]], rel=1e-9)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
    assert len(rows) == len(docs)
    for s in order:
        biggest = max(n for d, n in size.items() if source[d] == s)
        assert abs(taken[s] - target[s]) <= biggest
    again = {r.doc_id: r.taken for r in run(spark, "op2", SF_MID).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_op3_equals_article_regions(spark):
    import html
    pages = {p: (u, h or "") for p, u, h in rows_of(SF_SMALL, "select page_id, url, html from pages")}
    for r in run(spark, "op3").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id][1], re.S)
        blocks = re.split(r"</?(?:p|h1)>", body.group(1)) if body else []
        text = "\n\n".join(t for t in (" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in blocks) if t)
        assert r.text == text and r.n_chars == len(text) and r.url == pages[r.page_id][0]


def fp_brute(text):
    words = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_op4_equals_brute_force(spark, docs):
    fp = {d: fp_brute(t) for d, t, _ in docs}
    parent = {d: d for d in fp}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fp)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fp[a] ^ fp[b]).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op4").collect()}
    assert got == {d: (f"{fp[d]:016x}", root(d)) for d in ids}


def test_op5_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in run(spark, "op5", SF_MID).collect()}
    labels = dict(rows_of(SF_MID, "select doc_id, quality from labels"))
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [d for d in labels if d in rows and rows[d].held_out]
    right = sum(rows[d].predicted == labels[d] for d in held)
    assert right / len(held) >= 0.9
    assert {d: r.score for d, r in rows.items()} == {r.doc_id: r.score for r in run(spark, "op5", SF_MID).collect()}


def test_op6_finds_exactly_the_planted_passages(spark):
    docs = rows_of(SF_MID, "select doc_id, text from documents where text is not null")
    items = rows_of(SF_MID, "select item_id, text from benchmark")
    flat = [(d, " ".join(t.split())) for d, t in docs]
    truth = {(d, i) for i, t in items for d, x in flat if " ".join(t.split()) in x}
    assert truth and {(r.doc_id, r.item_id) for r in run(spark, "op6", SF_MID).collect()} == truth


def test_op7_edited_texts_and_likeness(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op7").collect()}
    by_text = {}
    for i, (d, x, _) in enumerate(docs):
        n, nxt = len(x) // 2, docs[(i + 1) % len(docs)][1]
        e = x[:len(x) - n] + nxt[:n]
        r = got[d]
        assert r.n_chars == len(x) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert by_text.setdefault(x, r.fingerprint) == r.fingerprint
        a, b = shingles(x), shingles(e)
        if min(len(a), len(b)) >= 200:
            assert abs(r.near_edited - len(a & b) / min(len(a), len(b))) < 5 * (0.25 / (0.25 * min(len(a), len(b)))) ** 0.5  # five sigma
        assert 0 <= r.near_next <= 1
    plan = run(spark, "op7")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan


def shingles(text, k=5):
    w = SPACE.findall(text)
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def test_op8_native_plan(spark):
    plan = run(spark, "op8")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op9_rules(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
    urls = dict(rows_of(SF_MID, "select page_id, url from pages"))
    for r in run(spark, "op9", SF_MID).collect():
        u = urls[r.page_id]
        m = re.match(r".*?://([^/?#]*)([^?#]*)", u or "", re.S)
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [x for x in rules if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fit, key=lambda x: len(x[0] + x[1]), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best and best[0] + best[1])
        assert r.verdict == (best[2] if best else r.verdict) and r.verdict in ("allow", "block")


def spans_brute(docs, run_=2, min_words=20):
    """Every run of ``run_`` or more sentences and ``min_words`` or more words; returns the removed sentences per document."""
    def cut(t):
        return [s for s in re.split(r"(?<=[.!?])\s+|\s*\n\s*", t) if s.strip()]
    first, hits = {}, defaultdict(set)
    for d, t, *_ in docs:
        s = [" ".join(x.lower().split()) for x in cut(t)]
        for i in range(len(s)):
            for j in range(i + run_, len(s) + 1):
                if sum(len(x.split()) for x in s[i:j]) < min_words:
                    continue
                if first.setdefault(hashlib.md5("\n".join(s[i:j]).encode()).digest(), (d, i)) == (d, i):
                    continue
                hits[d].update(range(i, j))
    return hits


def test_op10_equals_brute_force(spark, docs):
    hits = spans_brute(docs)
    rows = run(spark, "op10").collect()
    assert {r.doc_id: r.n_removed for r in rows} == {d: len(hits.get(d, ())) for d, *_ in docs}
    texts = {d: t for d, t, _ in docs}
    assert all(r.text == texts[r.doc_id] for r in rows if not r.n_removed)
    assert any(hits.values())


@pytest.mark.parametrize("kind", ["empty", "odd"])
def test_edge_tables(spark, tmp_path, kind):
    sf = (write_tables(spark, tmp_path) if kind == "empty" else
          write_tables(spark, tmp_path, ODD_DOCS, ODD_PAGES, ODD_ITEMS, ODD_LABELS, odd_vectors()))
    for name, fn in Q.QUERIES.items():
        rows = fn(spark, sf).collect()
        if kind == "empty":
            assert rows == [], name
        elif name in ("op3_main_text", "op9_url_templates"):
            assert len(rows) == len(ODD_PAGES), name
        elif name == "op13_sharded_kmeans":
            assert len(rows) == 6, name
        elif name not in ("op6_benchmark_leaks", "pipeline"):
            assert len(rows) == len(ODD_DOCS), name


def test_odd_rows_have_the_documented_results(spark, tmp_path):
    sf = write_tables(spark, tmp_path, ODD_DOCS, ODD_PAGES, ODD_ITEMS, ODD_LABELS)
    by = defaultdict(list)
    for r in run(spark, "op1", sf).collect():
        by[r.doc_id].append(r)
    assert [tuple(r)[1:4] for r in by[3]] == [(1, 0, 0)] * 2  # repeated rows lose nothing to each other
    assert by[8][0].n_removed == 299999 and by[10][0].n_removed == by[10][0].n_bytes
    four = {r.doc_id: r.component_id for r in run(spark, "op4", sf).collect() if r.doc_id is not None}
    assert four[1] == four[2] == 1 and four[10] == 9  # empty texts share fingerprint 0
    assert {r.taken for r in run(spark, "op2", sf).collect() if r.doc_id in (1, 2)} == {0}
    assert {(r.doc_id, r.item_id) for r in run(spark, "op6", sf).collect()} == {(9, 4), (10, 4)}
    nine = {r.page_id: r for r in run(spark, "op9", sf).collect()}
    assert (nine[1].host, nine[1].path, nine[1].rule, nine[1].verdict) == ("", "", None, "allow")
    assert (nine[2].host, nine[2].rule) == ("a.com", "com/")
    three = {r.page_id: r.text for r in run(spark, "op3", sf).collect() if r.page_id in (1, None, 6)}
    assert three == {1: "", None: "xy", 6: "t"}


def align_brute(rows):
    """Whole texts through both tokenizers; links counted in a dictionary."""
    from tabflow.llm import token_align as T
    p, n, out = T.Pair(*T.load()), Counter(), []
    for d, t in rows:
        t = t or ""
        a, b = p.a.encode(" " + t, add_special_tokens=False).ids, p.b.encode(t)
        whole = (" " + t).encode()
        if not t or b"".join(p.a_bytes[i] for i in a) != whole or b"".join(p.b_bytes[i] for i in b) != whole:
            out.append((d, 0, 0, [], ""))
            continue
        ends_b, end = {}, 0
        for j, y in enumerate(b):
            end += len(p.b_bytes[y])
            ends_b[end] = j
        links, groups, i0, j0, end = [], [], 0, 0, 0
        for i, x in enumerate(a):
            end += len(p.a_bytes[x])
            if end in ends_b:
                j = ends_b[end]
                groups.append(",".join(map(str, a[i0:i + 1])) + "|" + ",".join(map(str, b[j0:j + 1])))
                links.append((x, b[j]))
                i0, j0 = i + 1, j + 1
        n.update(links)
        out.append((d, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (_, y), c in n.items():
        top[y] = max(top[y], c)
    return sorted(((d, a, b, len(ln), len(ln), sum(n[x] == top[x[1]] for x in ln), sum(n[x] for x in ln), h) for d, a, b, ln, h in out), key=str)


ODD_TEXTS = [(1, None), (2, ""), (3, " "), (4, "a <|endoftext|> b <s> <0x41> c"), (5, "  x  y\n\nz \x00 é ́a 　 b "), (6, "▁"),
             (6, "one two"), (6, "one two"), (None, "null id, 's text"), (8, "a" * 30000), (9, "it's " * 9000)]


@pytest.mark.parametrize("hot", [1 << 20, 20, 1])
def test_op11_equals_brute_force(spark, docs, hot):
    from tabflow.llm import token_align as T
    rows = [(d, t) for d, t, _ in docs] + ODD_TEXTS
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in T.score(T.align(df), hot=hot).collect()]
    assert sorted(got, key=str) == align_brute(rows)


def test_op11_query_groups_and_whole_vocabularies(spark, docs):
    from tabflow.llm import token_align as T
    assert sorted((tuple(r) for r in run(spark, "op11").collect()), key=str) == align_brute([(d, t) for d, t, _ in docs])
    p = T.Pair(*T.load())
    known = [a for a in range(p.n_a) if p.identity[a] >= 0]
    assert all(p.a_bytes[a] == p.b_bytes[p.identity[a]] for a in known) and len(known) > 10000
    df = T.align(spark.createDataFrame([(1, "hello world")], "doc_id long, text string"), with_groups=True)
    r = df.first()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256


def kmeans_brute(rows, k=8, rounds=10, limit=1 << 27):
    """Plain Lloyd over Python integers."""
    import math
    pts = [(v, [max(-limit, min(limit, math.floor(1024 * x))) for x in e]) for v, e, *_ in rows
           if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(pts, key=lambda p: (p[0] is None, hashlib.sha256(f"3:{p[0]}".encode()).hexdigest() if p[0] is not None else "", p[1]))
    cent = [x for _, x in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(cent))
    for _ in range(rounds):
        at = [near(x)[1] for _, x in pts]
        for i in range(len(cent)):
            mine = [x for (_, x), a in zip(pts, at) if a == i]
            if mine:
                cent[i] = [sum(c) // len(mine) for c in zip(*mine)]
    got = [(v, *near(x)[::-1]) for v, x in pts]
    per = Counter()
    for _, c, d in got:
        per[c] += d
    return sorted(((v, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, cent[c])).encode()).hexdigest()) for v, c, d in got), key=str)


@pytest.mark.parametrize("width", [16, 5, 64])
def test_op13_equals_brute_force(spark, width):
    from tabflow.llm import sharded_kmeans as S
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()][:300] + odd_vectors()
    rows = spark.createDataFrame(rows, VECTORS).collect()  # components as stored floats
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = S.with_inertia(*S.cluster(df, width=width)).collect()
    assert sorted((tuple(r) for r in got), key=str) == kmeans_brute([tuple(r) for r in rows])


def test_op13_few_vectors(spark):
    from tabflow.llm import sharded_kmeans as S
    for rows in ([], odd_vectors()[:6], odd_vectors()[:8]):
        df = spark.createDataFrame(rows, VECTORS)
        got = S.with_inertia(*S.cluster(df)).collect()
        assert sorted((tuple(r) for r in got), key=str) == kmeans_brute([tuple(r) for r in df.collect()])


def jaccard_brute(rows, shingle=4, percent=85):
    """All pairs of distinct sets; union-find over the links."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = SPACE.findall((t or "").translate(lower))
        sets.append(frozenset(" ".join(w[i:i + shingle]) for i in range(max(len(w) - shingle + 1, 1))) if w else frozenset())
    distinct = sorted({s for s in sets if s}, key=len)
    up = {s: s for s in distinct}

    def root(s):
        while up[s] is not s:
            s = up[s]
        return s
    for i, x in enumerate(distinct):
        for y in distinct[i + 1:]:
            if 100 * len(x) < percent * len(y):
                break
            n = len(x & y)
            if 100 * n >= percent * (len(x) + len(y) - n):
                up[root(x)] = root(y)
    low = {}
    for (d, _), s in zip(rows, sets):
        if s and d is not None:
            low[root(s)] = min(d, low.get(root(s), d))
    return sorted(((d, len(s), low.get(root(s)) if s else d) for (d, _), s in zip(rows, sets)), key=str)


def families(seed=7, bases=6, copies=25):
    """Near copies of a few texts with a common line, edited at random: links in chains and stars."""
    import random
    rnd, out, line = random.Random(seed), [], "the very common line that all of these documents hold"
    for _ in range(bases):
        base = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([8, 40, 90]))]
        for _ in range(copies):
            words = [f"e{rnd.randrange(10 ** 6)}" if rnd.random() < rnd.choice([0, 0.005, 0.01, 0.03]) else w for w in base]
            out.append((len(out), " ".join(words[:rnd.choice([len(words), len(words), len(words) - 3])] + line.split())))
    return out


@pytest.mark.parametrize("leaders,block", [(2, 4096), (1, 5), (3, 2)])
def test_op12_equals_brute_force(spark, docs, leaders, block):
    from tabflow.llm import jaccard_join as J
    rows = [(d, t) for d, t, _ in docs] + [(i + 10 ** 6, t) for i, t in families()] + ODD_TEXTS
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((tuple(r) for r in J.classes(df, leaders=leaders, block=block).collect()), key=str)
    assert got == jaccard_brute(rows)
    assert len({c for _, _, c in got}) < len(rows) - 50


@pytest.mark.parametrize("percent,shingle", [(50, 2), (95, 3), (70, 1)])
def test_op12_at_other_thresholds(spark, percent, shingle):
    from tabflow.llm import jaccard_join as J
    rows = families(seed=percent)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = J.classes(df, shingle=shingle, percent=percent, leaders=1, block=7).collect()
    assert sorted((tuple(r) for r in got), key=str) == jaccard_brute(rows, shingle, percent)
