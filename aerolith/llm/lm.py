"""Language-model scores by a weighted backoff automaton over all n-grams.

Texts are lower-cased (A-Z); tokens are words ``[^\\x20\\x09-\\x0D]+`` and one
end per text. Training documents are those whose crc32(doc_id as text) mod 7
is not 2. All words' counts c, their total N and number V come from all
training texts; p1(w) = (c + 1) / (N + V + 1) leaves one share for unseen words.

Model. All n-grams up to three tokens of the training texts are kept, with
their whole counts, at every size. With discount D,

    p(w | h) = max(c(hw) - D, 0) / c(h) + l(h) * p(w | h'),  l(h) = D * kinds(h) / c(h)

where h' is h without its first word and kinds(h) the number of different words
seen after h; p(w | h') where h was never seen. Probabilities sum to 1 after any h.

Automaton. States are the histories of two words and of one word that occur in
training, and the root. An arc leads from h on each w seen after h, with weight
log10 p(w | h), to the longest history that ends the text so far; a failure arc
leads from h to h' with weight log10 l(h). A document is read from left to
right: a state without an arc for the next word is left by failure arcs, whose
weights add up, until an arc (the root has one for every word) takes the word.

Distribution. Documents are read in blocks of bounded size, written with a
number for each token. A block asks for the counts of its n-grams as tries,
one for each bucket of first words: sorted, delta-coded, compressed, words
named by 64-bit hashes or, the ``NUMBERED`` most frequent, by their number. Each token starts one n-gram of three (texts end in an
end and two blanks), so counts of two and of one are sums within the trie. A
bucket adds up the tries of all blocks and answers with arrays in the order
asked. Frequent first words are split over further buckets by their second
word, and their sums are added by the block. From its answers a block builds
its part of the automaton, and its documents walk in it side by side. What is
gathered grows with the corpus; only the list of most frequent words is collected.

A text of more than ``PART_BYTES`` is cut into parts that know two tokens
before and after; a walk enters a part with the state that these two lead to.

Defined cases: null text is empty, its only token the end; a null doc_id counts
as an empty id text (trained on); repeated rows count and score each; without
training documents N = V = 0 and every token has probability 1; an empty table
gives no rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import fold, staged, table, texts
from aerolith.session import scratch_path

FOLDS, HELD = 7, 2
DISCOUNT = 0.5
END, BLANK = b"\n", b"\n\n"  # no word holds a line feed
BLOCK_BYTES = 12 << 20
BUCKET_BYTES = 20 << 20
PART_BYTES = 4 << 20
#: tokens that a lane of the walk reads
LANE = 1024
#: a block reports its words of this count or more; those of all blocks with more than half a bucket's share are split
LISTED = 8
#: the most frequent words, which a trie names by their number; all others by their hash
NUMBERED = 1 << 16


def parts(text: bytes, most: int) -> Iterator[tuple[list[bytes], list[bytes], list[bytes]]]:
    """(two tokens before, tokens, two tokens after) of the parts of a text."""
    before: list[bytes] = []
    here: list[bytes] | None = None
    at = 0
    while at < len(text) or here is None:
        stop = min(len(text), at + most)
        while stop < len(text) and not text[stop: stop + 1].isspace():
            stop += 1
        tokens = text[at:stop].lower().split()
        if stop == len(text):
            tokens += [END, BLANK, BLANK]
        at = max(stop, at + 1)
        if here is None:
            here = tokens
        elif len(tokens) < 2:  # too few to follow: the part before takes them
            here += tokens
        else:
            yield before, here, tokens[:2]
            before, here = (before + here)[-2:], tokens
    yield before, here[:-2], here[-2:]


def pack(a: np.ndarray) -> bytes:
    """Whole numbers of at least 0, in as few bytes as the largest needs, byte by byte, compressed."""
    top = int(a.max(initial=0))
    size = next(s for s in (1, 2, 4, 8) if top < 1 << 8 * s)
    planes = np.ascontiguousarray(a, dtype=f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(f"<u{size}").ravel().astype(np.uint64 if size == 8 else np.int64)


BLOCKS = ["rows", "doc_ids", "no_id", "held", "before", "scored", "seq", "words", "n_bytes", "n_tokens", "listed"]


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES, least: int = LISTED) -> DataFrame:
    """Per block of documents (row, doc_id, held_out, text) its parts as numbers of words."""
    often = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))

    def made(held: list, size: int) -> pa.RecordBatch:
        rows, ids, out, found = zip(*held)
        coded = pa.array([w for p in found for x in p for w in x], pa.binary()).dictionary_encode()
        seq, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        n = np.bincount(seq, minlength=len(words))
        listed = [{"h": _signed(words[i]), "n": int(n[i])} for i in np.flatnonzero(n >= least)]
        values = [pack(np.array(rows)), np.array([i or 0 for i in ids], np.int64).tobytes(), pack(np.array([i is None for i in ids])),
                  pack(np.array(out)), pack(np.array([len(p[0]) for p in found])), pack(np.array([len(p[1]) for p in found])),
                  pack(seq), zstandard.ZstdCompressor(level=3).compress(b" ".join(words)), size, len(seq), listed]
        kinds = [*[pa.binary()] * 8, pa.int64(), pa.int64(), often]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=BLOCKS)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("row", "doc_id", "held_out")]
            for row, i, out, text in zip(*columns, texts(batch)):
                for p in parts(text, part_bytes):
                    held.append((row, i, out, p))
                    size += min(len(text), part_bytes) + 1
                    if size >= block_bytes:
                        yield made(held, size)
                        held, size = [], 0
        if held:
            yield made(held, size)
    schema = ", ".join(f"{c} binary" for c in BLOCKS[:8]) + ", n_bytes long, n_tokens long, listed array<struct<h: long, n: long>>"
    return docs.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


def _signed(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


class Block:
    """The n-grams of a block of parts: words in the order of their hashes, and
    the distinct n-grams of one, two and three words as a trie in that order."""

    def __init__(self, row):
        self.rows, self.held = unpack(row["rows"]).astype(np.int64), unpack(row["held"]).astype(bool)
        self.ids = pd.array(np.frombuffer(row["doc_ids"], np.int64), dtype="Int64")
        self.ids[unpack(row["no_id"]).astype(bool)] = pd.NA
        self.before, self.scored = unpack(row["before"]).astype(np.int64), unpack(row["scored"]).astype(np.int64)
        words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b" ")
        h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        order = np.argsort(h)
        self.h, self.v = h[order], len(words)
        rank = np.empty(self.v, np.int32)
        rank[order] = np.arange(self.v, dtype=np.int32)
        self.seq = rank[unpack(row["seq"])]
        # each part: tokens before, scored tokens, two after; an n-gram starts at all but the two after
        self.first = np.cumsum(self.before + self.scored + 2) - (self.before + self.scored + 2)
        starts = np.ones(len(self.seq), bool)
        after = self.first + self.before + self.scored
        starts[after] = starts[after + 1] = False
        counted = np.repeat(~self.held, self.before + self.scored + 2)
        for k in (0, 1):  # those before are counted where they are scored
            counted[self.first[self.before > k] + k] = False
        self._trie(np.flatnonzero(starts), counted)

    def _trie(self, at: np.ndarray, counted: np.ndarray) -> None:
        ab = self.seq[at].astype(np.int64) * self.v + self.seq[at + 1]
        if 2 * self.v ** 3 < 1 << 63:
            ab *= self.v
            ab += self.seq[at + 2]
            ab *= 2
            ab += counted[at]
            ab.sort()
            seen = (ab & 1).astype(np.int32)
            ab >>= 1
            c = (ab % self.v).astype(np.int32)
            ab //= self.v
        else:
            c = self.seq[at + 2]
            order = np.lexsort((c, ab))
            ab, c, seen = ab[order], c[order], counted[at][order].astype(np.int32)
        new2 = np.append(True, ab[1:] != ab[:-1])
        at = np.flatnonzero(new2 | np.append(True, c[1:] != c[:-1]))
        self.seen = np.add.reduceat(seen, at)
        self.word3, ab, new2 = c[at], ab[at], new2[at]
        self.pair = np.cumsum(new2, dtype=np.int32) - 1  # of each n-gram of three, its first two
        self.pairs = ab[new2]  # v * first word + second word, ascending
        first, self.word2 = (x.astype(np.int32) for x in np.divmod(self.pairs, self.v))
        new1 = np.append(True, first[1:] != first[:-1])
        self.one = np.cumsum(new1, dtype=np.int32) - 1  # of each pair, its first word
        self.ones = first[new1]
        self.begin = np.append(np.flatnonzero(new2), len(at))  # of each pair, its n-grams

    def buckets(self, n: int, hot: dict[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(bucket, ones, pairs, n-grams of three), each ascending. Frequent first
        words are in buckets of their own, and in each of them even without pairs."""
        h = self.h[self.ones]
        bucket = (h % np.uint64(n)).astype(np.int64)
        split = np.array([hot.get(int(x), 0) for x in h.tolist()], np.int64) if hot else np.zeros(len(h), np.int64)
        of_pair, also = bucket[self.one], []
        where = np.flatnonzero(split[self.one])
        if len(where):
            base = {x: i for i, x in enumerate(sorted(hot))}
            offset = np.cumsum([0] + [hot[x] for x in sorted(hot)])
            own = {int(i): n + offset[base[int(h[i])]] for i in np.flatnonzero(split)}
            second = (self.h[self.word2[where]] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            of_pair[where] = np.array([own[int(i)] for i in self.one[where]]) + (second % split[self.one[where]].astype(np.uint64)).astype(np.int64)
            also = [(b, i) for i, first in own.items() for b in range(first, first + split[i])]
        extra: dict[int, list[int]] = {}
        for b, i in also:
            extra.setdefault(int(b), []).append(i)
        order = np.argsort(of_pair, kind="stable")
        names, begin = np.unique(of_pair[order], return_index=True)
        groups = dict(zip(names.tolist(), np.split(order, begin[1:])))
        for b in sorted(groups.keys() | extra.keys()):
            pairs = groups.get(b, np.zeros(0, np.int64))
            size = self.begin[pairs + 1] - self.begin[pairs]
            grams = np.repeat(self.begin[pairs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            yield b, np.unique(np.append(self.one[pairs], extra.get(b, [])).astype(np.int64)), pairs, grams

    def question(self, frequent: np.ndarray, ones: np.ndarray, pairs: np.ndarray, grams: np.ndarray) -> dict[str, bytes]:
        """A bucket's trie: its words (those among the ``frequent`` hashes by their
        place there), and words as numbers among these, in the order of hashes."""
        used = np.zeros(self.v, bool)
        used[self.ones[ones]] = used[self.word2[pairs]] = used[self.word3[grams]] = True
        words = np.flatnonzero(used)
        number = np.cumsum(used) - 1
        h = self.h[words]
        place = np.searchsorted(frequent, h)
        known = np.append(frequent, np.uint64(0))[place] == h
        return {"known": pack(np.diff(place[known], prepend=0)), "words": pack(np.diff(h[~known], prepend=np.uint64(0))), "ones": pack(np.diff(number[self.ones[ones]], prepend=0)),
                "n_pairs": pack(np.diff(np.searchsorted(self.one[pairs], np.append(ones, len(self.ones))))),
                "seconds": pack(number[self.word2[pairs]]), "n_grams": pack(self.begin[pairs + 1] - self.begin[pairs]),
                "thirds": pack(number[self.word3[grams]]), "seen": pack(self.seen[grams])}


QUESTION = ["known", "words", "ones", "n_pairs", "seconds", "n_grams", "thirds", "seen"]
ANSWER = ["c1", "k1", "c2", "k2", "c3"]


def questions(held: DataFrame, n_buckets: int, hot: dict[int, int], frequent) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                for b, *trie in block.buckets(n_buckets, hot):
                    q = block.question(frequent.value, *trie)
                    yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([row["block"]], pa.int64()),
                                                      *[pa.array([q[c]], pa.binary()) for c in QUESTION]], names=["bucket", "block", *QUESTION])
    return held.drop("listed").mapInArrow(run, "bucket long, block long, " + ", ".join(f"{c} binary" for c in QUESTION))


def numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the number of each value among them."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.append(np.ones(min(len(key), 1), bool), key[1:] != key[:-1])
    number = np.empty(len(key), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return key[new], number


def _answers(n_buckets: int, frequent: np.ndarray, rows: pd.DataFrame) -> pd.DataFrame:
    """The counts of all n-grams of a bucket's tries, for each trie in its order;
    and once the bucket's training tokens and words."""
    asked = [{c: unpack(r[c]) for c in QUESTION} for r in rows[QUESTION].to_dict("records")]
    words = [np.sort(np.append(frequent[np.cumsum(q["known"], dtype=np.int64)], np.cumsum(q["words"].astype(np.uint64), dtype=np.uint64)))
             for q in asked]
    every = np.unique(np.concatenate(words))
    v = len(every)
    ones, pairs, grams, seen = [], [], [], []
    for q, w in zip(asked, words):
        number = np.searchsorted(every, w)
        ones.append(number[np.cumsum(q["ones"].astype(np.int64))])
        pairs.append(np.repeat(ones[-1], q["n_pairs"]) * v + number[q["seconds"]])
        grams.append(number[q["thirds"]].astype(np.int32))
        seen.append(q["seen"].astype(np.int32))
    sizes = [np.cumsum([len(x) for x in part])[:-1] for part in (ones, pairs, grams)]
    one, of_one = numbered(np.concatenate(ones))
    pair, of_pair = numbered(np.concatenate(pairs))
    del pairs, words
    key = np.repeat(of_pair, np.concatenate([q["n_grams"] for q in asked])).astype(np.int64)
    del asked
    key *= v
    key += np.concatenate(grams)
    del grams
    gram, of_gram = numbered(key)
    del key
    c3 = np.bincount(of_gram, np.concatenate(seen), len(gram)).astype(np.int64)
    del seen
    up = gram // v
    c2, k2 = (np.bincount(up, x, len(pair)).astype(np.int64) for x in (c3, c3 > 0))
    up = np.searchsorted(one, pair // v)
    c1, k1 = (np.bincount(up, x, len(one)).astype(np.int64) for x in (c2, c2 > 0))
    cut = [np.split(x, at) for x, at in zip((of_one, of_pair, of_gram), sizes)]
    out = [{"block": b, **{n: pack(x[i]) for n, x, i in zip(ANSWER, (c1, k1, c2, k2, c3), (i1, i1, i2, i2, i3))}, "n_tokens": 0, "n_words": 0}
           for b, i1, i2, i3 in zip(rows["block"], *cut)]
    bucket, n_words = int(rows["bucket"].iloc[0]), int((c1 > 0).sum())
    whole = bucket < n_buckets  # else one frequent word, by a part of its pairs
    out[0] |= {"n_tokens": int(c1.sum()), "n_words": n_words if whole else 0}
    table = pd.DataFrame(out).assign(bucket=bucket, split_word=pd.array([None] * len(out), dtype="Int64"))
    if n_words and not whole:
        table.loc[0, "split_word"] = int(every[one[0]]) - (1 << 63)
    return table


class Automaton:
    """States: pairs, then words (of a block's trie), then the root. Only what
    training has seen has arcs; ``step`` reads a word."""

    def __init__(self, block: Block, c1, k1, c2, k2, c3, unit: float):
        self.v, self.pairs, self.n = block.v, block.pairs, len(block.pairs)
        self.root = self.n + len(block.ones)
        self.c1 = np.zeros(block.v)
        self.c1[block.ones] = c1
        self.p1 = (self.c1 + 1) / unit
        self.state_of = np.full(block.v, self.root)  # the state of a word alone
        self.state_of[block.ones] = np.where(c1 > 0, self.n + np.arange(len(c1)), self.root)
        self.word = block.ones.astype(np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            left = DISCOUNT * k1 / c1, DISCOUNT * k2 / c2  # l(h)
            p2 = np.maximum(c2 - DISCOUNT, 0) / c1[block.one] + left[0][block.one] * self.p1[block.word2]
            seen = np.flatnonzero(c3 > 0)
            h, w = block.pair[seen].astype(np.int64), block.word3[seen]
            to = self._pair(block.word2[h].astype(np.int64) * self.v + w)
            p3 = (c3[seen] - DISCOUNT) / c2[h] + left[1][h] * np.where(to >= 0, p2[to], 0)
            del seen
            self.log2, self.log3, self.log1 = np.log10(p2), np.log10(p3), np.log10(self.p1)
            self.fail = np.append(np.log10(left[1]), np.log10(left[0]))
        self.fail_to = np.append(self.state_of[block.word2], np.full(len(block.ones), self.root))
        self.arc2 = c2 > 0
        self.arc3, self.to3 = h * self.v + w, to  # ascending

    def _pair(self, key: np.ndarray) -> np.ndarray:
        """Number of the pairs of the given keys, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.pairs, key), self.n - 1)
        return np.where(self.pairs[at] == key, at, -1)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log weight, next state) of each word read in its state."""
        weight, to = np.zeros(len(state)), np.full(len(state), -1)
        left = np.flatnonzero(state < self.n)
        if len(left) and len(self.arc3):
            key = state[left] * self.v + word[left]
            at = np.minimum(np.searchsorted(self.arc3, key), len(self.arc3) - 1)
            hit = self.arc3[at] == key
            weight[left[hit]], to[left[hit]] = self.log3[at[hit]], self.to3[at[hit]]
            left = left[~hit]
        state = state.copy()
        weight[left] = self.fail[state[left]]
        state[left] = self.fail_to[state[left]]
        left = np.flatnonzero((state >= self.n) & (state < self.root) & (to < 0))
        if len(left):
            at = self._pair(self.word[state[left] - self.n] * self.v + word[left])
            hit = (at >= 0) & self.arc2[at]
            weight[left[hit]] += self.log2[at[hit]]
            to[left[hit]] = at[hit]
            left = left[~hit]
            weight[left] += self.fail[state[left]]
            state[left] = self.root
        left = np.flatnonzero((state == self.root) & (to < 0))
        weight[left] += self.log1[word[left]]
        to[left] = self.state_of[word[left]]
        return weight, to


def walked(block: Block, automaton: Automaton, most: int = LANE) -> np.ndarray:
    """The log probability of each part, its tokens read from left to right.
    Lanes of up to ``most`` tokens are read side by side; a lane that does not
    begin its document first reads the two tokens before, without their weight."""
    n_lanes = -(-block.scored // most)
    part = np.repeat(np.arange(len(block.scored)), n_lanes)
    lane = np.arange(len(part)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)
    begin = block.first[part] + block.before[part] + lane * most
    size = np.minimum(block.scored[part] - lane * most, most)
    ahead = np.minimum(begin - block.first[part], 2)
    order = np.argsort(-(size + ahead), kind="stable")
    begin, size, ahead, part = (x[order] for x in (begin - ahead, size + ahead, ahead, part))
    score, state = np.zeros(len(part)), np.full(len(part), automaton.root)
    for t in range(int(size.max(initial=0))):
        live = np.searchsorted(-size, -t)  # lanes of more than t tokens
        weight, state[:live] = automaton.step(state[:live], block.seq[begin[:live] + t])
        score[:live] += np.where(t >= ahead[:live], weight, 0)
    return np.bincount(part, score, len(block.scored))


SCORES = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _finish(n_buckets: int, hot: dict[int, int], unit: float, lane: int, held: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    block = Block(held.iloc[0])
    c1, k1 = np.zeros(len(block.ones)), np.zeros(len(block.ones))
    c2, k2, c3 = (np.zeros(n, np.int64) for n in (len(block.pairs), len(block.pairs), len(block.word3)))
    told = {r["bucket"]: r for r in answers.to_dict("records")}
    for b, ones, pairs, grams in block.buckets(n_buckets, hot):
        a = {c: unpack(told[b][c]) for c in ANSWER}
        c1[ones] += a["c1"]
        k1[ones] += a["k1"]
        c2[pairs], k2[pairs], c3[grams] = a["c2"], a["k2"], a["c3"]
    automaton = Automaton(block, c1, k1, c2, k2, c3, unit)
    score = walked(block, automaton, lane)
    owner = np.repeat(np.arange(len(block.scored)), block.scored)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(block.scored) - block.scored, block.scored)
    token = block.seq[np.repeat(block.first + block.before, block.scored) + at]
    n = len(block.scored)
    return pd.DataFrame({"row": block.rows, "doc_id": block.ids, "held_out": block.held, "n_tokens": block.scored, "n_known": np.bincount(owner, automaton.c1[token] > 0, n).astype("int64"),
                         "base_score": np.bincount(owner, automaton.log1[token], n), "score": score})


def _staged_by_block(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder in buckets of its ``block``, so that it
    is read where it lies when the answers are brought to it."""
    spark, name = df.sparkSession, f"lm_blocks_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("path", os.path.join(scratch_path(spark, "llm"), name))
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name))
    return spark.table(name)


def scored(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES,
           lane: int = LANE, listed: int = LISTED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark, held_out = docs.sparkSession, fold(F.col("doc_id"), FOLDS) == HELD
    held = _staged_by_block(blocks(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                                               held_out.alias("held_out"), "text"), block_bytes, part_bytes, listed))
    size, tokens = held.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    n_buckets = max(1, -(-size // bucket_bytes))
    share = max(listed, tokens // (2 * n_buckets))  # at most 2 * n_buckets words have more
    often = staged(held.select(F.explode("listed").alias("w")).groupBy("w.h").agg(F.sum("w.n").alias("n")))
    hot = {r["h"] + (1 << 63): -(-r["n"] // share) + 1 for r in often.where(F.col("n") > share).collect()} if n_buckets > 1 else {}
    first = often.orderBy(F.desc("n"), "h").limit(NUMBERED).select("h").collect()
    frequent = spark.sparkContext.broadcast(np.sort(np.array([r["h"] + (1 << 63) for r in first], np.uint64)))
    schema = "bucket long, block long, " + ", ".join(f"{c} binary" for c in ANSWER) + ", n_tokens long, n_words long, split_word long"
    names = [c.split()[0] for c in schema.split(", ")]
    told = staged(questions(held, n_buckets, hot, frequent).groupBy("bucket")
                  .applyInPandas(lambda rows: _answers(n_buckets, frequent.value, rows)[names], schema))
    total, distinct = told.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)),
                               F.coalesce(F.sum("n_words"), F.lit(0)) + F.countDistinct("split_word")).first()
    finish = partial(_finish, n_buckets, hot, float(total + distinct + 1), lane)
    scores = (held.drop("listed", "n_bytes", "n_tokens").groupBy("block").cogroup(told.select("block", "bucket", *ANSWER).groupBy("block"))
              .applyInPandas(lambda block, answers: finish(block, answers), SCORES))
    sums = scores.groupBy("row", "doc_id", "held_out").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
