"""Fill-in-the-middle training texts, cut by rank and select on packed boundary bits.

A text's UTF-8 bytes give one bit each: 1 where a code point begins. The bits of a slice of whole documents are packed into 64-bit words,
with a directory of the running popcount before each block of eight words. Rank at a document's ends gives its number of code points n
(the total popcount of its bits); select on the two drawn ranks gives the bytes to cut at. Both take a block from the directory, at most
eight words and six halvings of one word, for all documents of a slice at once. Only n and the two byte positions come back from Python: the
pieces are cut and put together in the JVM.

Draws: h1 to h4 are the first four groups of eight hex digits of the SHA-256 of ``<seed>:<doc_id>``. The prefix ends after the smaller of h1 mod (n + 1)
and h2 mod (n + 1) code points, the middle after the larger. Reruns and other partitionings agree.

Defined results: a null text is the empty text, which is plain. A text that holds a marker is plain. A null doc_id draws as the empty string. Rows that repeat draw alike.
Bytes that are no valid UTF-8 are kept; n then counts the bytes that can begin a code point. Extra columns stay unless a new one has their name. An empty table gives an
empty result. Arrow batches hold 1000 rows at most from here on in the session.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import packed, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_U = np.uint64
_BLOCK = 8


class Boundaries:
    """Rank and select over the bits that mark where code points begin."""

    def __init__(self, raw: np.ndarray):
        self.length = len(raw)
        blocks = len(raw) // (64 * _BLOCK) + 1
        bytes_ = np.zeros(blocks * _BLOCK * 8, np.uint8)
        bits = np.packbits((raw & 0xC0) != 0x80, bitorder="little")
        bytes_[:len(bits)] = bits
        self.words = bytes_.view("<u8")
        self.before = np.zeros(blocks + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words).reshape(blocks, _BLOCK).sum(axis=1, dtype=np.int64), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many code points begin before each byte of ``at``."""
        word = at >> 6
        block = word // _BLOCK
        out = self.before[block].copy()
        for k in range(_BLOCK):
            w = block * _BLOCK + k
            out += np.where(w < word, np.bitwise_count(self.words[w]), 0)
        mask = (_U(1) << (at & 63).astype(_U)) - _U(1)
        return out + np.bitwise_count(self.words[word] & mask)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte at which code point number k (from 0) begins; the length of all bytes where there are no more."""
        total = int(self.before[-1])
        inside = np.minimum(k, max(total - 1, 0))
        block = np.searchsorted(self.before, inside, "right") - 1
        block = np.minimum(block, len(self.before) - 2)
        left = inside - self.before[block]
        word = block * _BLOCK
        for step in range(_BLOCK - 1):  # on to the word that holds the bit
            here = np.bitwise_count(self.words[word]).astype(np.int64)
            go = (left >= here) & (word == block * _BLOCK + step)
            left = np.where(go, left - here, left)
            word = np.where(go, word + 1, word)
        bits, at = self.words[word], word * 64
        for width in (32, 16, 8, 4, 2, 1):  # on to the bit within it
            low = np.bitwise_count(bits & _U((1 << width) - 1)).astype(np.int64)
            go = left >= low
            left = np.where(go, left - low, left)
            at = np.where(go, at + width, at)
            bits = np.where(go, bits >> _U(width), bits)
        return np.where(k < total, at, self.length)


def cuts(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> pa.StructArray:
    """Per text: n, the two ranks, and the bytes before the first and before the second cut."""
    out = np.zeros((5, len(texts)), np.int64)
    for lo, hi, raw, offsets in ts.slices(texts):
        bits = Boundaries(raw)
        begin = bits.rank(offsets)
        n = np.diff(begin)
        a, b = first[lo:hi] % (n + 1), second[lo:hi] % (n + 1)
        a, b = np.minimum(a, b), np.maximum(a, b)
        place = [np.where(r == 0, 0, np.where(r == n, np.diff(offsets), bits.select(begin[:-1] + r) - offsets[:-1])) for r in (a, b)]
        out[:, lo:hi] = n, a, b, *place
    return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n", "a", "b", "at_a", "at_b"])


def cut_column(text: F.Column, first: F.Column, second: F.Column) -> F.Column:
    """:func:`cuts` of columns."""

    @F.arrow_udf("n long, a long, b long, at_a long, at_b long")
    def cut(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        return cuts(text, first.to_numpy(zero_copy_only=False).astype(np.int64), second.to_numpy(zero_copy_only=False).astype(np.int64))

    return cut.asNondeterministic()(text, first, second)  # else the planner repeats it for each use


def draw(doc_id: F.Column, k: int, seed: int = 1) -> F.Column:
    """h1 to h4: group k (1 to 4) of eight hex digits of the SHA-256 of ``<seed>:<doc_id>``, unsigned."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_percent: int = 90, spm_percent: int = 20, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` with n, form (plain, psm or spm), prefix_chars, middle_chars and output.

    ``fim_percent`` of the documents are rearranged, ``spm_percent`` of these suffix first.
    """
    small_batches(docs.sparkSession)
    rows, opened = packed(docs, [id_col, text_col])
    here = lambda c: F.col("`" + c.replace("`", "``") + "`")
    text, h = F.coalesce(here(text_col).cast("string"), F.lit("")), [draw(here(id_col), k, seed) for k in (1, 2, 3, 4)]
    cut = cut_column(text, h[0], h[1])
    holds = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | holds | (h[2] % 100 >= fim_percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.withColumn("_cut", cut).withColumn("form", form)
    raw, mark = text.cast("binary"), lambda m: F.lit(m).cast("binary")
    at_a, at_b = F.col("_cut.at_a").cast("int"), F.col("_cut.at_b").cast("int")
    prefix, middle = F.substr(raw, F.lit(1), at_a), F.substr(raw, at_a + 1, at_b - at_a)
    suffix = F.substr(raw, at_b + 1, F.octet_length(raw) - at_b)
    psm = F.concat(mark(PREFIX), prefix, mark(SUFFIX), suffix, mark(MIDDLE), middle)
    spm = F.concat(mark(SUFFIX), suffix, mark(PREFIX), prefix, mark(MIDDLE), middle)
    is_plain = F.col("form") == "plain"
    made = rows.withColumns({"n": F.col("_cut.n"), "prefix_chars": F.when(~is_plain, F.col("_cut.a")), "middle_chars": F.when(~is_plain, F.col("_cut.b") - F.col("_cut.a")),
                             "output": F.when(is_plain, text).when(F.col("form") == "psm", psm.cast("string")).otherwise(spm.cast("string"))})
    return opened(made, ["n", "form", "prefix_chars", "middle_chars", "output"])


def restored(output: F.Column, form: F.Column) -> F.Column:
    """The text again, from an output and its form alone. A rearranged output holds each marker once."""
    before = lambda s, m: F.substring_index(s, m, 1)
    after = lambda s, m: F.substring_index(s, m, -1)
    middle = after(output, MIDDLE)
    psm = F.concat(before(after(output, PREFIX), SUFFIX), middle, before(after(output, SUFFIX), MIDDLE))
    spm = F.concat(before(after(output, PREFIX), MIDDLE), middle, before(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
