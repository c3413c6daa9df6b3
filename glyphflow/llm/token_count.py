"""Token counts of whole texts; huge texts are encoded in overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .hashing import slices
from .pieces import Counts, load
from .shared import remembers

#: Texts of more characters are huge: cut into chunks of so many, each with so many of the next.
CHUNK = 16_384
OVERLAP = 256
#: So many tokens after a boundary must be alike in both chunks.
AGREE = 4
#: A boundary is no nearer to the end of the left chunk: a special token that is cut there may begin so many characters before.
MARGIN = 32
SLICE = 4 << 20


def stable(char: str) -> bool:
    """Whether a character never joins with what stands before it when text is composed.

    All that do are marks, conjoining Hangul letters or Kirat Rai vowel signs; characters not assigned yet may.
    """
    if char < "\x80":
        return True
    code = ord(char)
    return unicodedata.category(char) not in ("Mn", "Mc", "Me", "Cn") and not (0x1100 <= code < 0x1200 or 0xA960 <= code < 0xA980 or 0xD7B0 <= code < 0xD800 or 0x16D40 <= code < 0x16D80)


def boundaries(text: str, begin: int, encoded, after: int, upto: int) -> dict[int, int]:
    """Places in text, after one and up to another, where a pre-token begins, with the index of its first token."""
    out, last = {}, None
    for i, ((a, _), word) in enumerate(zip(encoded.offsets, encoded.word_ids, strict=True)):
        if word != last:
            last = word
            if after < begin + a <= upto and stable(text[begin + a]):
                out[begin + a] = i
    return out


def splice(text: str, left_from: int, left, left_to: int, right_from: int, right) -> tuple[int, int] | None:
    """(index in left, index in right) of the first boundary in the overlap that is stable in both, or None.

    The covered pre-tokenizers scan ahead and never look back, so where both chunks begin a pre-token at one place, at a
    character that composes with nothing before it, all that follows is cut alike. As a check, the ids after it must be
    the same in both chunks, AGREE or as many as the left one has but for its last word, which may be cut.
    """
    ours = boundaries(text, left_from, left, right_from, left_to - MARGIN)
    theirs = boundaries(text, right_from, right, right_from, left_to - MARGIN)
    words = left.word_ids
    whole = len(words)
    while whole and words[whole - 1] == words[-1]:
        whole -= 1
    for at in sorted(ours.keys() & theirs.keys()):
        i, j = ours[at], theirs[at]
        n = min(AGREE, whole - i, len(right.ids) - j)
        if n > 0 and left.ids[i : i + n] == right.ids[j : j + n]:
            return i, j
    return None


def count_huge(tokenizer: Tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of text, as if encoded whole. The memory in use is that of two chunks.

    When no boundary of an overlap is proven, the overlap doubles, until one is found or the rest of the text is in the
    left chunk: what is encoded at once is a chunk, or else the longest run of text without a boundary, doubled at most.
    """
    encode = lambda a, b: tokenizer.encode(text[a:b], add_special_tokens=False)
    total, begin, skip, size, n = 0, 0, 0, overlap, len(text)
    left_end = min(n, chunk)
    left = encode(0, left_end)
    while left_end < n:
        start = max(begin, left_end - size)
        right_end = min(n, start + chunk)
        right = encode(start, right_end) if start > begin and right_end > left_end else None
        found = splice(text, begin, left, left_end, start, right) if right else None
        if found and found[0] >= skip:
            total += found[0] - skip
            begin, left, left_end, skip, size = start, right, right_end, found[1], overlap
        else:
            size *= 2
            left_end = min(n, left_end + size)
            left = encode(begin, left_end)
    return total + len(left.ids) - skip


@lru_cache(maxsize=1)
def counter(path: str) -> Counts:
    return Counts(load(path))


remembers(counter.cache_clear)


def count_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = 2048, huge: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit, a row for each row of docs; tokenizer: the path of a .json file.

    Null and empty texts have 0 bytes and 0 tokens; nothing is cut off. Equal rows are counted each. No rows give no rows.
    Other columns of docs are not looked at, whatever their names. Texts over huge characters are counted in chunks, others
    by pieces: both give what the library gives for the whole text. A tokenizer for which that isn't proven is refused.
    No shuffle: one pass over id and text. The path must be there on every executor (it comes with the installation).
    """
    counter(tokenizer)  # refused here, not in a task

    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = counter(tokenizer)
        for texts in batches:
            long = pc.greater(pc.utf8_length(texts), huge)
            out = np.zeros(len(texts), np.int64)
            others = [counts.of(data, offsets) for _, _, data, offsets in slices(texts.filter(pc.invert(long)), SLICE)]
            is_long = long.to_numpy(zero_copy_only=False)
            if others:
                out[~is_long] = np.concatenate(others)
            for i in np.flatnonzero(is_long).tolist():
                out[i] = count_huge(counts.tokenizer, texts[i].as_py(), huge, min(OVERLAP, huge // 4))
            yield pa.array(out)

    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(t).cast("long").alias("n_bytes"), n_tokens(t).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
