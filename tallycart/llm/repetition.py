"""Quality rules by repetition: characters inside repeated n-grams and lines, from rolling codes of several lengths.

Every text is read whole. Null and empty texts have no words and fail the base rule. Extra columns of the input are left
aside; rows with equal or null ids are judged one by one. All work is row-local: no shuffle, no state between rows.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.common import pieces, texts_of
from tallycart.llm.textcode import Packed, covered, grams, mixed, repeats

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Shares of a text's word characters that may lie in repeated n-grams (later occurrences only), by n, and in lines
    that occurred before. The lengths follow published repetition filters for web text (three words at least); the shares
    leave alone a short text in which one line stands twice."""

    grams: dict[int, float] = field(default_factory=lambda: {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15})
    lines: float = 0.20
    min_words: int = 50
    repeat_words_percent: int = 50


def measured(texts: list[str], limits: Limits) -> dict[str, np.ndarray]:
    """The measures and verdicts of texts that fit in one step."""
    packed = Packed.of(texts)
    starts, ends = packed.words()
    words = packed.codes(starts, ends)
    text = packed.text_of(starts)
    chars = np.zeros(len(packed.buffer) + 1, dtype=np.int64)
    np.cumsum((packed.buffer & 0xC0) != 0x80, out=chars[1:])
    width = chars[ends] - chars[starts]
    per_text = lambda weights: np.bincount(text, weights=weights, minlength=len(texts)).astype(np.int64)
    n_words, word_chars = per_text(None), per_text(width)

    line_starts, line_ends = packed.lines()
    until = np.searchsorted(starts, line_ends)
    since = np.searchsorted(starts, line_starts)
    filled = np.flatnonzero(until > since)
    line_text = packed.text_of(line_starts[filled])
    _, again = repeats(mixed(packed.codes(line_starts[filled], line_ends[filled]) + mixed(line_text.astype(np.uint64))))
    total = np.concatenate(([0], np.cumsum(width)))
    line_chars = total[until[filled]] - total[since[filled]]
    n_dup_lines = np.bincount(line_text[again], minlength=len(texts))
    dup_line_chars = np.bincount(line_text[again], weights=line_chars[again], minlength=len(texts)).astype(np.int64)

    def windows(n: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, first = grams(words, text, n, among)
        return first, *repeats(mixed(codes + mixed(text[first].astype(np.uint64))))

    first, any_, _ = windows(3)
    n_repeat = per_text(covered(first[any_], 3, len(words)))
    failed = (n_words < limits.min_words) | (100 * n_repeat > limits.repeat_words_percent * n_words)
    out = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": packed.count(SYMBOLS[packed.buffer]),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "dup_line_chars": dup_line_chars,
    }
    kept = ~failed & (dup_line_chars <= limits.lines * word_chars)
    among = first[any_]  # a longer window can only repeat where the shorter one at its start does
    for n, most in sorted(limits.grams.items()):
        first, any_, again = windows(n, among)
        among = first[any_]
        inside = per_text(covered(first[again], n, len(words)) * width)
        out[f"dup_{n}gram_chars"] = inside
        kept &= inside <= most * word_chars
    return out | {"kept": kept}


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits | None = None) -> DataFrame:
    """One row per document: counts, characters inside repeated lines and n-grams, and the verdict ``kept``."""
    limits = limits or Limits()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    counts += [f"dup_{n}gram_chars" for n in limits.grams]
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", *counts, "base_failed", "kept"]
    schema = ", ".join([f"doc_id {dict(slim.dtypes)['doc_id']}", *(f"{c} long" for c in counts), "base_failed boolean", "kept boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in pieces(texts):
                found = measured(texts[a:b], limits)
                columns = [batch.column("doc_id").slice(a, b - a), *(pa.array(found[c].astype(np.int64)) for c in counts)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found["base_failed"]), pa.array(found["kept"])], names)

    return slim.mapInArrow(run, schema)
