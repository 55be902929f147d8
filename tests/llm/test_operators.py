"""Each operator against a brute-force version on small rows: nulls in any
column, empty and long texts, ties, repeated rows, empty tables, extra columns
with clashing names."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from aerolith.llm import decontam, gbt, gru, lm, mixing, pii, pu, simhash, superkmer, tokens
from tests.conftest import SF_MID, SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, __id int, kind string, h double"
PASSAGE = " ".join(f"w{i % 41}x{i}" for i in range(60))
ITEM = " ".join(f"item{i}" for i in range(20))


def _rows():
    texts = [
        (1, "The quick brown fox jumps over the lazy dog.", "en", "a"),
        (2, "the QUICK brown fox jumps over the lazy dog.", "en", "a"),
        (3, None, None, None), (4, "", "fr", "b"), (5, "  \n\t ", None, "b"),
        (6, "Un deux trois quatre cinq six sept huit neuf dix. " * 12, "fr", "b"),
        (7, PASSAGE + " tail one", "en", "c"), (8, "head two " + PASSAGE, "en", "c"),
        (9, "same " * 400, "en", None), (10, f"before {ITEM.upper()} after", "en", "d"),
        (11, "one two", "en", "d"), (12, "one two", "en", "d"),
        (13, "mail a@b.c_d@e.fr ip 1.2.3.4.5 0255.1.1.1 card 4111 1111 1111 1111 tel +49 (30) 123-4567.", "de", "e"),
        (14, "long " + " ".join(f"q{i}" for i in range(30_000)), "en", "e"),
        (15, "x" * 70_000, "es", "e"), (16, "*** ### | < >\nline\nline\nline\n", "en", "e"), (None, "no id here", "en", "a"),
        (None, "no id here", "en", "a"), (None, None, None, None), (12, "one two", "en", "d"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "fp", 7, "k", None) for i, t, lang, s in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _got(df):
    return sorted(map(tuple, df.collect()), key=str)


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# op1
def _base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(d[::-1]))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


PII = [
    "a@b.c_d@e.f x@y.z%q@r.s-t.u é@x.de", "1.2.3.4.5.6.7.8 001.2.3.256 0255.1.1.1 999999999999.1.1.1",
    "4111-1111-1111-1111 41111111111111112 1 2 3 4 5 6 7 8 9 0 1 2", "+1 (017) 555-7713) +12 34 ++49 30 1234567. +1-2-3-4-5-6-7-8-9",
    "😀 a@b.co 😀 1.1.1.1 token = \"04dbebab91ab85687d33eeaaf9\" call (555) 123-4567", "1 " * 3000, "a" * 30_000 + "@", None, "",
]


def test_pii_base_spans(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(PII)], "doc_id long, text string, s string")
    for r in pii.find(df).collect():
        base = _base(PII[r.doc_id] or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        n = Counter(k for _, k, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in range(4))
        assert not base or set(text.split(",")) <= set(r.spans.split(","))


def test_pii_redaction(docs, empty):
    before = {r.doc_id: r for r in docs.where("doc_id is not null").collect()}
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id == 13:
            assert r.text == "mail <EMAIL><EMAIL> ip <IP>.5 <IP> card <CARD> tel <PHONE>."
            assert r.n_chars == len(r.text) and "4111" not in r.text
        elif r.doc_id is not None:
            assert (r.text, r.n_chars) == (before[r.doc_id].text, before[r.doc_id].n_chars)
    assert pii.redacted(empty).count() == 0 and pii.find(empty).count() == 0


def test_pii_long_secrets_and_mail_names_are_whole(spark):
    secret, name = "9f3A" * 75, "long.name" * 12
    docs = spark.createDataFrame([(i, f"token = {secret} mail {name} (at) host (dot) com end") for i in range(30)],
                                 "doc_id long, text string")
    spans = {(k, a, b) for r in pii.find(docs).collect() for k, a, b in (s.split(":") for s in r.spans.split(","))}
    text = docs.first().text
    assert ("secret", "0", str(text.index(secret) + len(secret))) in spans
    assert ("email", str(text.index(name)), str(text.index(" end"))) in spans
    assert not any("9f3A" in r.text or "name" in r.text for r in pii.redacted(docs).collect())
    long = spark.createDataFrame([(1, "a" * 200_000), (2, "token=" + "b" * 200_000 + "!"), (3, "token=short " * 20_000)],
                                 "doc_id long, text string")
    assert {r.doc_id for r in pii.find(long).where("spans <> ''").collect()} <= {2}


def test_em_tells_reliable_labelers():
    counts = {(0, "+++0+"): 60.0, (0, "0---+"): 40.0, (0, "++00+"): 10.0, (0, "0-00+"): 10.0}
    post = pii.expectation_maximisation(counts)
    assert post[0, "+++0+"] > 0.9 > 0.1 > post[0, "0---+"]


# op2
def test_quality_rules(docs, empty, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 17)] + [(None, 1), (1, None)], "doc_id long, quality int")
    forest = gbt.trained(docs, labels)
    for r in gbt.judged(docs, forest).where("doc_id is not null").collect():
        t = next(x[1] for x in _rows() if x[0] == r.doc_id) or ""
        w = _words(t)
        c = Counter(zip(w, w[1:], w[2:]))
        rep = {j for i in range(len(w) - 2) if c[tuple(w[i: i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if _words(x)]
        want = (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(rep) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert gbt.judged(empty, gbt.trained(empty, labels)).count() == 0


def test_trees_are_monotone_and_flat():
    rng = np.random.default_rng(1)
    x = rng.random((800, len(gbt.SIGNS)))
    y = ((x[:, 2] < 0.5) ^ (rng.random(800) < 0.1)).astype(float)
    forest = gbt.fit(x, y)
    assert ((forest.score(x) > 0.5) == (y > 0.5)).mean() > 0.85
    for f in np.flatnonzero(gbt.SIGNS < 0):
        more = x.copy()
        more[:, f] += rng.random(800)
        assert (forest.margin(more) <= forest.margin(x) + 1e-9).all()


# op3
def test_mixing_targets(docs, empty):
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for i, t, _, s, *_ in _rows():
        sizes[s] += len(_words(t))
    names = sorted((s for s in sizes if s is not None)) + [None]
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * w[s] / free > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    target = {s: 3 * sizes[s] if s in capped else left * w[s] / free for s in names}
    assert len(rows) == len(_rows())
    by_size = {round(v, 6): s for s, v in target.items()}
    for r in rows:
        s = by_size[round(r.target, 6)]
        assert r.source_size == sizes[s] and r.taken <= 3 * r.size
        assert r.size == 0 or r.taken // r.size in (math.floor(target[s] / sizes[s]), math.floor(target[s] / sizes[s]) + 1)
    assert _got(mixing.mix(docs)) == _got(mixing.mix(docs.repartition(2)))
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    emitted = mixing.mixed(docs)
    assert emitted.columns == docs.columns
    assert emitted.select(F.sum(mixing.size_of(F.col("text")))).first()[0] == sum(r.taken for r in rows)


# op4
def _dwords(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 40])
def test_decontamination(docs, empty, spark, monkeypatch, block):
    items = [(1, ITEM), (2, "quick brown"), (3, None), (4, " ..."), (None, "lazy dog"), (5, "lazy"), (10, ITEM), (6, "same same same")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    monkeypatch.setattr(decontam.blocks, "__defaults__", (block,))
    got = {(r.doc_id, r.n_words): r for r in decontam.decontaminate(docs, bench).collect()}
    for i, t, *_ in _rows():
        w, hit, found = _dwords(t), set(), set()
        for item, x in items:
            p = _dwords(x)
            if item is None or not p:
                continue
            for q in ([p[k: k + 13] for k in range(len(p) - 12)] if len(p) >= 13 else [p]):
                for k in range(len(w) - len(q) + 1):
                    if w[k: k + len(q)] == q:
                        hit |= set(range(k, k + len(q)))
                        found.add(str(item))
        r = got[i, len(w)]
        assert (r.n_hit, r.n_items) == (len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
    clean = decontam.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not r.contaminated for r in decontam.decontaminate(docs, bench).collect())
    assert decontam.decontaminate(empty, bench).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0


# op5
@pytest.mark.parametrize("sizes", [{}, {"bucket_bytes": 2000, "hot_windows": 20, "reported": 2}])
def test_substring_dedup(docs, empty, sizes):
    seen = Counter()
    for _, t, *_ in _rows():
        w = _words(t)
        seen.update(tuple(w[i: i + 35]) for i in range(len(w) - 34))
    want = []
    for i, t, *_ in _rows():
        w = _words(t)
        gone = {j for k in range(len(w) - 34) if seen[tuple(w[k: k + 35])] > 1 for j in range(k, k + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert _got(superkmer.deduplicate(docs, **sizes)) == sorted(want, key=str)
    assert superkmer.deduplicate(empty).count() == 0


def test_equal_hashes_are_compared(monkeypatch):
    monkeypatch.setattr(superkmer, "rolling", lambda h, width: np.zeros(len(h) - width + 1, np.uint64))
    a, b = " ".join(f"a{i}" for i in range(40)).encode(), " ".join(f"b{i}" for i in range(36)).encode()
    flag, windows = superkmer.repeated_windows([a, b, a + b" z"], np.array([1, 1, 1]))
    assert windows.tolist() == [6, 2, 7] and flag.tolist() == [True] * 6 + [False] * 2 + [True] * 6 + [False]


# op6
def test_token_counts(docs, empty):
    import random

    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = tokens.load(path)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.counted(docs, path, chunk=1000, overlap=16).collect())
    want = Counter()
    for i, x, *_ in _rows():
        n = len(t.encode(x or "", add_special_tokens=False).ids)
        want[i, len((x or "").encode()), n, n > 1024] += 1
    assert got == want and tokens.counted(empty, path).count() == 0
    rnd = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "é", "1", "<|endoftext|>", "'s", ".", " the", "\t", "　", "😀", "x" * 30, "\x85", "\xa0"]
    for _ in range(500):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 120)))
        assert tokens.counts([s], t, rnd.randint(8, 40), rnd.randint(1, 8)) == [len(t.encode(s, add_special_tokens=False).ids)]


# op7
@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 3000, "part_bytes": 900, "lane": 7, "listed": 3, "bucket_bytes": 20_000}])
def test_lm_scores(docs, empty, sizes):
    rows = [(i, t) for i, t, *_ in _rows()]
    tok = [((t or "").encode().lower().split() + [b"\n"]) for _, t in rows]
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in rows]
    grams = [Counter(g for t, h in zip(tok, held) if not h for g in zip(*(t[k:] for k in range(n)))) for n in (1, 2, 3)]
    total, distinct = sum(grams[0].values()), len(grams[0])
    kept = grams

    after_of = [{} for _ in kept]
    for x, successors in zip(kept, after_of):
        for g, c in x.items():
            successors.setdefault(g[:-1], []).append(c)

    def p(g):
        if len(g) == 1:
            return (grams[0][g] + 1) / (total + distinct + 1)
        head = g[:-1]
        if head not in kept[len(head) - 1]:
            return p(g[1:])
        c, after = grams[len(head) - 1][head], after_of[len(g) - 1].get(head, [])
        rest = (c - sum(after) + lm.DISCOUNT * len(after)) / c
        return max(kept[len(g) - 1].get(g, lm.DISCOUNT) - lm.DISCOUNT, 0) / c + rest * p(g[1:])
    want = []
    for (i, _), t, h in zip(rows, tok, held):
        score = sum(math.log10(p(tuple(t[max(k - 2, 0): k + 1]))) for k in range(len(t)))
        base = sum(math.log10(p((w,))) for w in t)
        want.append((str(i), h, len(t), sum((w,) in grams[0] for w in t), total, round(base, 5), round(score, 5)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5))
           for r in lm.scored(docs, **sizes).collect()]
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=2e-4)
    assert len(got) == len(want) and lm.scored(empty).count() == 0


def test_lm_keeps_rare_ngrams_of_a_large_corpus(spark):
    train = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2][:6]
    rows = [(i, "a b " * 100_000) for i in train[:5]] + [(train[5], "once seen words stand here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm.scored(docs).collect()}[train[5]]
    # each later token was seen once, in that context only: 0.5 after one word, 0.5 + 0.5 * 0.5 after two
    assert got.train_tokens == 1_000_011 and got.n_known == got.n_tokens == 6
    unit = got.train_tokens + 8 + 1
    want = math.log10(2 / unit) + math.log10(0.5) + 4 * math.log10(0.75)
    assert abs(got.score - want) < 1e-3 and got.base_score < 5 * math.log10(6 / unit)


# op8
def _fingerprint(t):
    w = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    w = _words(w)
    if not w:
        return 0
    sh = [" ".join(w[i: i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(docs, empty):
    fps = [_fingerprint(t) for _, t, *_ in _rows()]
    group = list(range(len(fps)))
    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 4:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    smallest = {}
    for g, r in zip(group, _rows()):
        if r[0] is not None:
            smallest[g] = min(smallest.get(g, r[0]), r[0])
    want = [(r[0], f"{fp:016x}", smallest.get(g)) for r, fp, g in zip(_rows(), fps, group)]
    assert _got(simhash.near_duplicates(docs)) == sorted(want, key=str)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicated(empty).count() == 0


def test_dedup_keeps_one_row_of_each_group_under_a_repeated_id(spark):
    x, y = "a first text that stands under id five", "some quite other words under the same id"
    df = spark.createDataFrame([(5, x), (5, y)], "doc_id long, text string")
    assert _got(simhash.deduplicated(df)) == [(5, x), (5, y)]
    df = spark.createDataFrame([(5, x), (5, y), (3, x.upper()), (5, y.upper()), (7, y)], "doc_id long, text string")
    assert _got(simhash.deduplicated(df)) == [(3, x.upper()), (5, y.upper())]


def test_golay_keys_meet_within_two_bits():
    golay, rng = simhash.Golay(), np.random.default_rng(5)
    v = rng.integers(0, 1 << 23, 400)
    for u in (v, v ^ (1 << 3), v ^ (1 << 3) ^ (1 << 19)):
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(golay.keys(v), golay.keys(u)))


def test_links_connect_all_close_fingerprints(spark):
    rng = np.random.default_rng(8)
    centre = rng.integers(-2**63, 2**63 - 1, 60)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 5), replace=False)) for c in centre for _ in range(40)]
    fps = sorted({(x + 2**63) % 2**64 - 2**63 for x in near})
    label = {r.fp: r.label for r in simhash.labelled(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()}
    u = np.array(fps, dtype=np.int64)
    group = np.arange(len(u))
    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count((u ^ u[i]).view(np.uint64)) <= 4):
            if group[i] != group[j]:
                group[group == max(group[i], group[j])] = min(group[i], group[j])
    assert [label[x] for x in fps] == u[group].tolist()


# op9, op10
def test_language(docs, empty):
    net = gru.trained(docs)
    rows = gru.labelled(docs, net).collect()
    assert len(rows) == len(_rows())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and (r.doc_id not in (3, 4, 5) or r.lang_pred == "und")
    assert gru.labelled(empty, gru.trained(empty)).count() == 0
    assert {r.lang_pred for r in gru.labelled(docs, gru.trained(empty)).collect()} == {"und"}


def test_gradients_by_differences():
    net = gru.fit([("a", b"abcd" * 16), ("b", b"xyzw" * 16)], updates=1)
    x, y = np.random.default_rng(0).integers(97, 101, (6, 5)), np.array([0, 1, 0, 1, 1])

    def loss():
        p = net.position_probabilities(x, np.ones(x.shape, np.float32))
        return -np.log(p[:, y, np.arange(5)]).mean()
    for w, g in zip(gru._parameters(net), gru._gradient(net, x, y)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = w[at], 1e-2
        w[at] = old + step
        up = loss()
        w[at] = old - step
        down = loss()
        w[at] = old
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.02)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = gru.op9_language(spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95


def test_quality_edges(docs, empty, spark):
    labels = spark.createDataFrame([(i, i % 3 > 0) for i in range(1, 9)], "doc_id long, q boolean").selectExpr("doc_id", "int(q) quality")
    rows = pu.scored(docs, pu.trained(docs, labels)).collect()
    assert len(rows) == len(_rows())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert pu.scored(empty, pu.trained(empty, labels)).count() == 0
    assert {r.score for r in pu.scored(docs, pu.trained(docs, labels.limit(0))).collect()} == {0.5}


def test_quality_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = pu.op10_quality(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([g >= 0.3 for g in good]) > 0.98


def test_pipeline_equals_stages_by_hand(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    model = pu.trained(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    good = {r.doc_id for r in pu.scored(docs, model).where("predicted = 1").collect()}
    kept = docs.where(F.col("doc_id").isin(list(good)))
    heads = {r.component_id for r in simhash.near_duplicates(kept).collect()}
    kept = kept.where(F.col("doc_id").isin(list(heads)))
    dirty = {r.doc_id for r in decontam.decontaminate(kept, bench).where("contaminated").collect()}
    kept = kept.where(~F.col("doc_id").isin(list(dirty)))
    clean = pii.redacted(kept)
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(clean).collect() if r.size}
    want = Counter({r.doc_id: taken.get(r.doc_id, 0) for r in clean.collect()})
    assert Counter(r.doc_id for r in out.collect()) == +want
    assert out.columns == docs.columns
