"""Token counts with overlap resynchronisation.

A text of more than ``CHUNK`` characters is encoded in chunks that overlap,
with offsets, and two neighbours are spliced at a boundary in their overlap
that is proven stable: the character there is a space after a character that is
not white space and before one that is not white space, and both encodings have
a token boundary at it.
The pre-tokenizer ends every piece before such a space whatever stands to the
left or right (only the piece after it takes the space along, and no special
string holds white space), and pieces are encoded on their own; so left of
it the first chunk and right of it the second equal the whole text's encoding.
Where an overlap has no such boundary, it is widened to twice its length, at
most up to the whole rest of the text.

A shorter text is cut at all its stable boundaries, and the tokens of its
pieces, each encoded on its own, add up. The pieces recur, so a worker keeps
the counts of those it has met, up to ``KNOWN`` of them, and has the library
encode only new ones.

The count is that of the library without begin, end or added special tokens,
truncation or padding; special strings in texts are handled as its default.

Defined cases: null text is empty and has no bytes and tokens; a null doc_id
stays null; repeated rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from aerolith.llm.common import table

CHUNK = 32_768
OVERLAP = 512
LIMIT = 1024
#: texts whose pieces are looked up together
BATCH = 128
#: counts of pieces a worker keeps
KNOWN = 1_500_000
#: a space beside white space: not every space of the text is a stable boundary
UNSTABLE = re.compile(r" \s|\s ")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def stable(text: str, i: int) -> bool:
    return 0 < i < len(text) - 1 and text[i] == " " and not text[i - 1].isspace() and not text[i + 1].isspace()


def _starts(encoding, base: int) -> dict[int, int]:
    """Token number by the character (of the whole text) at which it starts."""
    out: dict[int, int] = {}
    for k, (a, _) in enumerate(encoding.offsets):
        out.setdefault(a + base, k)
    return out


def spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of a long text, chunk by chunk."""
    def encode(a: int, b: int):
        return tokenizer.encode(text[a:b], add_special_tokens=False)
    total, begin, stop = 0, 0, min(chunk, len(text))
    left, first = encode(begin, stop), 0  # first: the first token of this chunk that counts
    while stop < len(text):
        wide = overlap
        while True:
            a, b = max(begin, stop - wide), min(len(text), stop - wide + max(chunk, 2 * wide))
            right = encode(a, b)
            mine, other = _starts(left, begin), _starts(right, a)
            # from the right, so that chunks grow; both chunks hold the characters around it
            at = next((i for i in range(stop - 2, a, -1) if i in mine and i in other and mine[i] >= first and stable(text, i)), None)
            if at is not None:
                total += mine[at] - first
                begin, stop, left, first = a, b, right, other[at]
                break
            if a == begin:  # no boundary anywhere: this chunk begins where the last one did, and is longer
                stop = b
                left = encode(begin, stop)
                wide = overlap
                if stop == len(text):
                    break
                continue
            wide *= 2
    return total + len(left.ids) - first


def pieces(text: str) -> list[str]:
    """``text`` cut at its stable boundaries; all pieces but the first lack the
    space that they begin with."""
    parts = text.split(" ")
    if not UNSTABLE.search(text):
        if parts[0] and parts[-1]:
            return parts
    out = parts[:1]
    for before, part in zip(parts, parts[1:]):
        if before and part and not before[-1].isspace() and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


_known: dict[str, dict[str, int]] = {}  # by tokenizer file: counts of pieces after a space, this worker's


def counts(texts: list[str], tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP, known: dict[str, int] | None = None) -> list[int]:
    """Number of tokens of each text; ``known`` holds counts of pieces from one call to the next."""
    known = {} if known is None else known
    out = [0] * len(texts)
    short = [i for i, t in enumerate(texts) if len(t) <= chunk]

    def encoded(new: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(new, add_special_tokens=False)]
    for k in range(0, len(short), BATCH):
        cut = [pieces(texts[i]) for i in short[k: k + BATCH]]
        firsts = encoded([c.pop(0) for c in cut])
        new = list(set().union(*cut).difference(known))
        if len(known) + len(new) > KNOWN:
            known.clear()
            new = list(set().union(*cut))
        known.update(zip(new, encoded([" " + p for p in new])))
        for i, c, first in zip(short[k: k + BATCH], cut, firsts):
            out[i] = first + sum(map(known.__getitem__, c))
    for i, t in enumerate(texts):
        if len(t) > chunk:
            out[i] = spliced(tokenizer, t, chunk, overlap)
    return out


def counted(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; ``path``: the
    tokenizer's file, at the same place on every machine."""
    def run(batches):
        tokenizer = load(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = counts(texts, tokenizer, chunk, overlap, _known.setdefault(path, {}))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([k > LIMIT for k in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return counted(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
