"""Pivot search, mask search and prefix trie against brute force on small rows:
nulls in any column, empty and very long values, ties, repeated rows, empty
tables, extra columns with clashing names; and that they eliminate work."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import collapse, masks, pivots
from aerolith.llm.common import table
from tests.conftest import SF_MID, SF_SMALL

VECTORS = "vec_id long, embedding array<double>, label int, row long, vec string, dist int, block int, near int"


def _vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(160)]
    same = [0.5, -0.25, 0.1, 0.0, 0.7, 0.2, -0.9, 0.3]
    rows += [(i, same) for i in range(200, 260)]  # copies: ties at the top
    rows += [(50, rows[50][1]), (50, rows[7][1]), (7, rows[7][1])]  # repeated rows and ids
    rows += [(300, None), (350, [1.0, None, 2.0]), (400, [float("nan")] * 8), (450, [float("inf")] * 8), (500, []),
             (550, [3.0, 1.0]), (600, [0.0] * 8), (None, [2.0] * 8), (None, same), (-100, [1.5] * 8),
             (650, [1e30] * 8), (651, [-1e30] * 8), (700, [float(i % 3) for i in range(900)])]
    return [(i, v, 1, 5, "x", 2, 3, None) for i, v in rows]


def _vectors_expected(rows, top=5, every=50):
    good = [(i, [min(max(math.floor(256 * x), -2 ** 63), 2 ** 63) for x in v]) for i, v, *_ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for r, (i, q) in enumerate(good):
        if i is not None and i % every == 0:
            scored = []
            for s, (j, c) in enumerate(good):
                if s != r:
                    score = sum(a * b for a, b in zip(q, c))
                    scored.append((-min(max(score, -2 ** 63), 2 ** 63 - 1), math.inf if j is None else j))
            out += [(i, k + 1, None if j == math.inf else j, -s) for k, (s, j) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def _got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"query_bytes": 2000, "most_pivots": 3, "sample_rows": 9}, {"sample_rows": 3, "top": 2}])
def test_pivot_search_equals_brute_force(spark, options):
    rows = _vector_rows()
    got = _got(pivots.nearest(spark.createDataFrame(rows, VECTORS).repartition(5), **options))
    assert got == _vectors_expected(rows, options.get("top", 5))


def test_pivot_search_without_rows_or_queries(spark):
    assert pivots.nearest(spark.createDataFrame([], VECTORS)).collect() == []
    assert pivots.nearest(spark.createDataFrame([r for r in _vector_rows() if r[0] and r[0] % 50], VECTORS)).collect() == []
    one = pivots.nearest(spark.createDataFrame([(50, [1.0], 1, 1, "", 1, 1, 1)], VECTORS))
    assert one.columns == ["query_id", "rank", "vec_id", "score"] and one.collect() == []


def test_pivots_eliminate_candidates():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 400
    vec = np.floor(np.repeat(centres, 100, 0) + rng.normal(size=(2000, 16)) * 20)
    table_ = pivots.chosen(vec[::4])
    lengths = pivots.lengths(table_)
    side = pivots.Side(vec, pivots.distances(vec, table_).astype(np.float32), lengths)
    q = np.arange(0, 2000, 50)
    queries = pivots.Side(vec[q], pivots.distances(vec[q], table_).astype(np.float32), lengths)
    search = pivots.Search(queries, q, np.full(len(q), -1e300), 5)
    ids = np.arange(2000)
    search.run(side, ids, ids)
    scores = pivots.products(vec[q], vec)
    for i, row in enumerate(q):
        order = sorted((-scores[i, j], j) for j in ids if j != row)[:5]
        assert [(-s, j) for s, j in zip(*search.best[i][:2])] == order
    assert search.scored < len(q) * 2000 / 4


DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, terms string, item int, block int, score long"
ITEMS = "item_id long, text string, item int, doc_id long"


def _lexical_rows():
    texts = ["alpha beta gamma", "ALPHA beta, Beta; delta", "the cat the dog the end", "été Été naïve 日本 日本", None, "", " .,;- ",
             "same words here", "same words here", "same words here", "x1 y2 z3 " * 50, "alpha " * 3000, "gamma delta epsilon zeta",
             " ".join(f"q{i}" for i in range(20_000)), "beta", "the " * 40 + "cat"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "alpha beta"), (None, None), (1, "alpha beta"), (14, "beta")]
    items = ["alpha BETA beta", "the cat sat", "same words here", "nothing matches zzzz9", None, "", "日本 naïve", "x1 y2 z3 q17 q18 q19999 the",
             " ".join(f"q{i}" for i in range(150)) + " alpha delta"]
    return ([(i, t, "en", "s", 1, 3, "t", 4, 5, 6) for i, t in docs],
            [(i, t, 9, 9) for i, t in enumerate(items)] + [(2, "gamma", 9, 9), (None, "delta zeta", 9, 9)])


def _lexical_expected(docs, items, top=10):
    def terms(t):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)
    found = [(i, Counter(terms(t)), len(terms(t))) for i, t, *_ in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text, *_ in items:
        scored = []
        for i, c, n in found:
            if n:
                m = 25 + 75 * n * n_docs // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                            for t in terms(text) if t in c)
                if score > 0:
                    scored.append((-score, math.inf if i is None else i))
        out += [(item, k + 1, None if i == math.inf else i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"top": 1, "block_docs": 4}, {"block_bytes": 20, "block_docs": 3}])
def test_mask_search_equals_brute_force(spark, options):
    docs, items = _lexical_rows()
    got = _got(masks.ranked(spark.createDataFrame(docs, DOCS).repartition(2), spark.createDataFrame(items, ITEMS), **options))
    assert got == _lexical_expected(docs, items, options.get("top", 10))


def test_mask_search_on_given_documents(spark):
    docs, items = (table(spark, SF_SMALL, n) for n in ("documents", "benchmark"))
    expected = _lexical_expected([tuple(r) for r in docs.select("doc_id", "text").collect()],
                                 [tuple(r) for r in items.select("item_id", "text").collect()])
    assert _got(masks.ranked(docs, items)) == expected


def test_mask_search_of_empty_tables(spark):
    docs, items = _lexical_rows()
    none = masks.ranked(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS))
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.collect() == []
    assert masks.ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).collect() == []


def test_masks_finish_before_all_documents():
    rng = np.random.default_rng(1)
    n, v = 3000, 70  # more terms than a number has bits
    doc, term = np.nonzero(rng.random((n, v)) < np.linspace(0.5, 0.02, v))
    block = masks.Block(np.arange(n), np.full(n, 100), doc, term, rng.integers(1, 3, len(doc)), v)
    rank = masks.Ranking(np.arange(v), np.arange(v) ** 2 + 1, 10)
    rank.search(block)
    every = block.scores(np.arange(n), rank.terms, rank.weights)
    assert [(-s, i) for s, i in zip(rank.score, rank.ids)] == sorted((-s, i) for i, s in enumerate(every))[:10]
    assert rank.scored < n / 4


CONVERSATIONS = "conv_id long, turn long, role string, text string, pos int, a string, chunk int, n_convs int"


def _conversation_rows():
    rows = []
    for c in range(0, 45):  # families of 20; 40 to 44 without a base of four turns
        for t in range(c % 6 + (c == 0) * 5):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c // 7} words here"))
    rows += [(c, t, "user", "the same whole conversation") for c in range(100, 160) for t in range(4)]  # copies
    rows += [(200, None, "user", "first by null"), (200, 0, None, "no role"), (200, 1, "user", None), (200, 1, "user", None),
             (200, 1, "assistant", "tie"), (207, 5, "", ""), (207, None, None, None), (-5, 0, "user", "negative id"),
             (-40, 1, "user", "negative base"), (-45, 2, "user", "of a negative base"), (None, 0, "user", "no id"), (None, None, None, None)]
    rows += [(300, t, "user", "very " * (t % 5)) for t in range(700)] + [(301, t, "user", "very " * (t % 5)) for t in range(650)]
    return [(*r, 1, "x", 2, 3) for r in rows]


def _trie_expected(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        seq = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids, leaves, saved = Counter(n[:-1] for n in members if n), Counter(), Counter()
    for node, who in members.items():
        value = (len(who) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            leaves[node[:d]] += not kids[node]
    return sorted(((min(who), len(n), min(members[n[:-1]]) if n else None, len(who), kids[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, who in members.items()), key=str)


@pytest.mark.parametrize("chunk,piece,many", [(4096, 8192, 10_000), (7, 5, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, chunk, piece, many):
    monkeypatch.setattr(collapse, "CHUNK", chunk)
    monkeypatch.setattr(collapse, "MANY_CHILDREN", many)
    rows = _conversation_rows()
    got = collapse.trie(spark.createDataFrame(rows, CONVERSATIONS).repartition(6), piece)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert _got(got) == _trie_expected(rows)


def test_trie_on_given_conversations(spark):
    rows = [tuple(r) for r in table(spark, SF_MID, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert _got(collapse.trie(table(spark, SF_MID, "conversations"))) == _trie_expected(rows)


def test_trie_of_nothing_and_of_one_turnless_conversation(spark):
    assert collapse.trie(spark.createDataFrame([], CONVERSATIONS)).collect() == []
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)  # its only turn is within its head, and there is no base
    got = collapse.trie(spark.createDataFrame([(c, 0, "user", "hello there", 1, "x", 2, 3)], CONVERSATIONS)).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_long_conversation_is_numbered_across_partitions(spark):
    rows = spark.range(20_000).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                      F.concat(F.lit("t"), F.col("id")).alias("text")).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collapse.placed(rows)
        assert got.agg(F.count("*"), F.countDistinct("pos"), F.min("pos"), F.max("pos")).first() == (20_000, 20_000, 1, 20_000)
        expected = rows.select((F.col("turn") + 1).alias("pos"), F.md5(F.concat(F.lit("4:user"), F.col("text")).cast("binary")).alias("digest"))
        assert expected.exceptAll(got.select("pos", "digest")).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
