"""Quality rules by tokeniser fertility.

A public vocabulary measures every text: characters per token, the share of tokens that are single bytes because no piece
of the vocabulary holds a character, and the entropy of the text's tokens against that of as many different ones. Texts
of one language lie close together in these figures; what lies outside the language's band is rejected. A band is a
median of all documents that pass the base rules, and so many median deviations to either side; as figures over tokens
scatter less in longer texts, they are compared in deviations times the root of the number of tokens. So the band of a short
text is wider, and every text that passes the base rules is judged. Byte share and entropy differ between texts however long
they are, so their bands get no narrower beyond a number of tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.common import per_worker, stored

SYMBOLS = "#*$%&|<>"
#: Half the width of a band in median absolute deviations, and the least half width, by measure.
WIDTH = 8.0
LEAST_WIDTH = {"chars_per_token": 0.06, "byte_share": 0.02, "token_entropy": 0.15}
#: Tokens beyond which the bands of byte share and entropy get no narrower.
WHOLE = 512
_KEPT_WORDS = 2**20


class Pieces:
    """Pieces of a vocabulary with byte fallback, word by word; words are kept."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.kept: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        kept = self.kept
        new = [w for w in set(words) if w not in kept]
        if new:
            if len(kept) > _KEPT_WORDS:
                kept.clear()
                new = list(set(words))
            found = self.model.encode([w.decode() for w in new], num_threads=1)
            kept.update(zip(new, (np.array(i, np.uint16).tobytes() for i in found)))
        return np.frombuffer(b"".join(map(kept.__getitem__, words)), np.uint16)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of words which the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    rank = ids
    for k in range(1, window):
        # Numbers of windows of k + 1 words: at most one per place, so the product stays small.
        rank = np.unique(rank[:n + window - 1 - k] * len(numbers) + ids[k:], return_inverse=True)[1].astype(np.int64)
    again = np.bincount(rank)[rank] > 1
    inside = np.zeros(len(words) + 1, np.int64)
    places = np.flatnonzero(again)
    np.add.at(inside, places, 1)
    np.add.at(inside, places + window, -1)
    return int((np.cumsum(inside)[:-1] > 0).sum())


def measure(text: str, pieces: Pieces) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_tokens, n_byte_tokens, entropy in bits."""
    data = text.encode()
    words = data.split()
    word_chars = len(text) - (len(data) - sum(map(len, words)))
    lines = [line for line in data.split(b"\n") if line.strip()]
    ids = pieces.ids(words)
    counts = np.unique(ids, return_counts=True)[1]
    share = counts / max(1, len(ids))
    return (len(words), word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(ids),
            int(pieces.is_byte[ids].sum()), float(-(share * np.log2(share)).sum()) if len(ids) else 0.0)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")
MEASURED = "doc_id bigint, lang string, " + ", ".join(f"{n} bigint" for n in _COUNTS) + ", bits double"


def measures(docs: DataFrame, path: str) -> DataFrame:
    """Figures of every row of docs (doc_id, lang, text) over its whole text; a null text is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = per_worker(("pieces", path), lambda: Pieces(path))
        for batch in batches:
            rows = list(zip(*(measure(t.as_py() or "", pieces) for t in batch.column(2)))) or [()] * 8
            arrays = [pa.array(c, pa.int64()) for c in rows[:-1]] + [pa.array(rows[-1], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["doc_id", "lang", *_COUNTS, "bits"])

    found = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").mapInArrow(run, MEASURED)
    n = F.col("n_tokens")
    return found.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).withColumns({
        "chars_per_token": F.when(n > 0, F.col("word_chars") / n),
        "byte_share": F.when(n > 0, F.col("n_byte_tokens") / n),
        "token_entropy": F.when(n > 1, F.col("bits") / F.log2(n.cast("double"))),
    })


def _away(measure: str) -> Column:
    """Distance from the language's median in the unit in which bands are measured."""
    n = F.col("n_tokens") if measure == "chars_per_token" else F.least("n_tokens", F.lit(WHOLE))
    return F.abs(F.col(measure) - F.col(f"{measure}_mid")) * F.sqrt(n.cast("double"))


def bands(found: DataFrame) -> DataFrame:
    """Median and median deviation of each measure by language, over all rows that pass the base rules."""
    usable = found.where(~F.col("base_failed"))
    middle = stored(usable.groupBy("lang").agg(*[F.percentile_approx(m, 0.5, 1000).alias(f"{m}_mid") for m in LEAST_WIDTH]), "quality-medians")
    return usable.join(middle, "lang").groupBy("lang").agg(
        *[F.first(f"{m}_mid").alias(f"{m}_mid") for m in LEAST_WIDTH],
        *[F.percentile_approx(_away(m), 0.5, 1000).alias(f"{m}_dev") for m in LEAST_WIDTH])


def judge(docs: DataFrame, path: str, width: float = WIDTH) -> DataFrame:
    """Figures of every row with base_failed and kept.

    kept is false for rows that fail the base rules or lie outside their language's band in a measure. A null language is
    one of its own ("und"). Repeated rows are judged each for itself; an empty table gives no rows.
    """
    found = stored(measures(docs, path), "quality")
    inside: Column = F.lit(True)
    for m in LEAST_WIDTH:
        near = (F.abs(F.col(m) - F.col(f"{m}_mid")) <= LEAST_WIDTH[m]) | (_away(m) <= width * F.col(f"{m}_dev"))
        inside = inside & F.coalesce(near, F.lit(True))
    joined = found.join(stored(bands(found), "quality-bands"), "lang", "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"),
        "lang", "n_tokens", *LEAST_WIDTH)
