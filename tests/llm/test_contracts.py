"""Defined cases of the training-data operators that need rows of their own:
clashing column names, types kept, ids on several texts, letters, hot keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerolith.llm import common, gbt, gru, lm, mixing, pii, pu, simhash, superkmer
from tests.llm.test_operators import _got

PROSE = "the cat sat on the mat and looked at the dog that slept by the fire while rain fell on the roof of the old house"


def test_mixing_with_columns_of_its_own_names(spark):
    rows = [(i, PROSE, "ab"[i % 2], i, i, i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __s int, __of int, __copy int")
    plain = mixing.mixed(docs.drop("__s", "__of", "__copy"))
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in plain.collect())


@pytest.mark.parametrize("kind", ["int", "long", "smallint"])
def test_redaction_keeps_the_type_of_n_chars(spark, kind):
    rows = [(1, "write to a@b.de now", 19), (2, "nothing here", 12), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").withColumn("n_chars", F.col("n_chars").cast(kind))
    got = pii.redacted(docs)
    assert got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    text, n = got.where("doc_id = 1").select("text", "n_chars").first()
    assert text == "write to <EMAIL> now" and n == len(text)


def _labelled(spark, texts_of_7):
    rows = [(i, f"{PROSE} number {i}" if i % 2 else f"$$$ buy {i} ### now !!!") for i in range(60) if i != 7] + [(7, t) for t in texts_of_7]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    return docs, labels


def test_an_id_on_several_texts_is_learned_from_with_the_first(spark):
    texts = ["zzz last text", PROSE, None, "a first text"]
    several, labels = _labelled(spark, texts)
    one, _ = _labelled(spark, ["a first text"])
    for a, b in ((pu.training_rows(several, labels), pu.training_rows(one, labels)),):
        assert all(np.array_equal(x, y) for x, y in zip(a, b))
    a, b = (gbt.trained(d, labels) for d in (several, one))
    probe = spark.createDataFrame([(1, PROSE), (2, "### $$$"), (3, None)], "doc_id long, text string")
    assert _got(gbt.judged(probe, a)) == _got(gbt.judged(probe, b))


def test_number_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(i, PROSE, "en") for i in range(20)] + [(i, "der Hund und die Katze im Haus", "de") for i in range(20, 40)],
                                 "doc_id long, text string, lang string")
    net = gru.trained(docs)
    texts = {1: "²", 2: "Ⅷ ½ ٣", 3: "12 + 3", 4: "", 5: None, 6: "x", 7: "ª", 8: "日"}
    got = {r.doc_id: (r.lang_pred, r.score) for r in gru.labelled(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), net).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4, 5)) and all(got[i][0] in ("en", "de") for i in (6, 7, 8))


def test_positions_near_a_cut_have_context():
    rng = np.random.default_rng(2)
    rows = [(k, bytes(rng.choice(list(a), gru.TRAIN_STEPS))) for k, a in (("x", b"abc "), ("y", b"xyz ")) for _ in range(40)]
    net = gru.fit(rows, updates=40)
    text = bytes(rng.choice(list(b"abc "), 3 * gru.STEPS + 5))
    whole = np.frombuffer(text, np.uint8)[:, None]
    p = net.position_probabilities(whole, np.ones(whole.shape, np.float32))[:, :, 0]  # the whole text as one sequence
    assert np.abs(net.documents([text, b"", text[:50]])[0] - p.mean(0)).max() < 0.02
    assert net.documents([text[:50]])[0] == pytest.approx(net.position_probabilities(whole[:50], np.ones((50, 1), np.float32))[:, :, 0].mean(0), abs=1e-5)


def test_languages_learned_are_the_most_frequent(spark, monkeypatch):
    monkeypatch.setattr(gru, "LANGS", 2)
    rows = [(i, f"{PROSE} {i}", lang) for i, lang in enumerate(["en"] * 30 + ["de"] * 20 + ["fr"] * 5 + ["aa"] * 5)]
    assert gru.trained(spark.createDataFrame(rows, "doc_id long, text string, lang string")).langs == ["de", "en"]


@pytest.mark.parametrize("frequent", [1000, 3])
def test_frequent_fingerprints_and_components(spark, monkeypatch, frequent):
    monkeypatch.setattr(common, "FREQUENT", frequent)
    rows = [(i, PROSE) for i in range(100, 140)] + [(i, f"{PROSE} {'x' * i}") for i in range(5)] + [(50, None), (None, PROSE), (None, None), (60, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    fps = {t: simhash.fingerprint((t or "").encode()) for _, t in rows}
    label = {f: f for f in fps.values()}
    for _ in fps:  # chains of links
        for a in label:
            for b in label:
                if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= simhash.MAX_BITS:
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for i, t in rows:
        if i is not None:
            least[label[fps[t]]] = min(i, least.get(label[fps[t]], i))
    want = [(i, format(fps[t] % 2 ** 64, "016x"), least.get(label[fps[t]])) for i, t in rows]
    assert _got(simhash.near_duplicates(docs)) == sorted(want, key=str)


def test_runs_stay_packed_unless_their_own_minimiser_is_hot():
    rng = np.random.default_rng(4)
    lists = [[b"w%d" % x for x in rng.integers(0, 5000, 400)] for _ in range(50)]
    plain = superkmer.Runs(lists, {}, 64)
    keys, n = np.unique(superkmer.Runs(lists).key, return_counts=True)
    assert len(superkmer.Runs(lists, {(int(keys[0]) + 1) % 2 ** 64: 4}, 64).start) == len(plain.start)
    hot = int(keys[n.argmax()])
    spread = superkmer.Runs(lists, {hot: 4}, 64)
    split = spread.bucket < 0
    assert spread.windows[split].sum() == n.max() and (spread.windows[split] == 1).all()
    assert spread.windows.sum() == plain.windows.sum() and len(spread.start) <= len(plain.start) + 2 * n.max()


def test_automaton_walks_by_arcs_and_failure_arcs():
    # one block of a training text "a b c a b" and a held-out text "a b x c"
    texts = [(b"a b c a b", False), (b"a b x c", True)]
    tokens = [t.split() + [lm.END, lm.BLANK, lm.BLANK] for t, _ in texts]
    words = sorted({w for t in tokens for w in t})
    import zstandard
    row = {"rows": lm.pack(np.arange(2)), "doc_ids": np.arange(2).tobytes(), "no_id": lm.pack(np.zeros(2, int)),
           "held": lm.pack(np.array([h for _, h in texts])), "before": lm.pack(np.zeros(2, int)),
           "scored": lm.pack(np.array([len(t) - 2 for t in tokens])), "seq": lm.pack(np.array([words.index(w) for t in tokens for w in t])),
           "words": zstandard.ZstdCompressor().compress(b" ".join(words))}
    block = lm.Block(row)
    rank = {w: int(np.searchsorted(block.h, np.uint64(lm.xxhash.xxh64_intdigest(w)))) for w in words}
    c3 = block.seen.astype(float)
    c2, k2 = (np.bincount(block.pair, x, len(block.pairs)) for x in (c3, c3 > 0))
    c1, k1 = (np.bincount(block.one, x, len(block.ones)) for x in (c2, c2 > 0))
    total, distinct = c1.sum(), (c1 > 0).sum()
    assert (total, distinct) == (6, 4)
    machine = lm.Automaton(block, c1, k1, c2, k2, c3, total + distinct + 1)

    def read(state, word):
        weight, to = machine.step(np.array([state]), np.array([rank[word]]))
        return 10 ** weight[0], int(to[0])
    a1, one = read(machine.root, b"a")
    assert a1 == pytest.approx(3 / 11) and one == machine.state_of[rank[b"a"]]
    b2, ab = read(one, b"b")
    assert ab < machine.n and b2 == pytest.approx(1.5 / 2 + 0.5 / 2 * 3 / 11)
    c, bc = read(ab, b"c")
    pc2 = 0.5 / 2 + 1.0 / 2 * 2 / 11
    assert bc < machine.n and c == pytest.approx(0.5 / 2 + 1.0 / 2 * pc2)
    x, after = read(ab, b"x")  # unseen: two failure arcs, then the root's arc
    assert x == pytest.approx(1.0 / 2 * 1.0 / 2 * 1 / 11) and after == machine.root
    score = lm.walked(block, machine)
    assert lm.walked(block, machine, 2) == pytest.approx(score) and lm.walked(block, machine, 1) == pytest.approx(score)
    state, sums = machine.root, 0.0
    for w in tokens[1][:-2]:
        p, state = read(state, w)
        sums += np.log10(p)
    assert score[1] == pytest.approx(sums)


def test_pipeline_with_clashing_columns(spark, tmp_path):
    names = ["__s", "__of", "__fp", "__label", "__row", "__id", "__none", "__copy", "fp", "n", "label", "block"]
    docs = spark.createDataFrame([(i, f"{PROSE} {i} a@b.de", "en", "ab"[i % 2], 120, *[1] * len(names)) for i in range(30)],
                                 "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` int" for c in names))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "some other text of a benchmark")], "item_id long, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
