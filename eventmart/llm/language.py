"""Language identification by compression with per-language zstandard raw-content dictionaries."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import held_out, unit

SAMPLE_ROWS = 120  # distinct training texts of a language that go into its dictionary
SLICE = 400  # characters taken of each
CHUNK = 1024  # bytes that are compressed at once: few enough that the dictionary, not the text itself, explains them
MIN_MARGIN = 0.001  # relative difference of the two smallest sizes below which a language is not certain

_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalpha())

UNKNOWN = "und"


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", seed: int = 7) -> dict[str, bytes]:
    """Dictionaries by language, from slices of ``SAMPLE_ROWS`` distinct texts each, those with the smallest seeded draws.

    A draw follows from the text, so copies are one text, and a language of few distinct texts keeps them all.
    The driver sees one number and that sample for each language.  Rows without text or language teach nothing.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and length(text) > 0")
    rows = rows.withColumn("draw", unit(F.col("text"), seed=seed))
    smallest = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = rows.groupBy("lang", "draw").agg(F.lit(1).alias("one")).withColumn("place", smallest).filter(F.col("place") <= SAMPLE_ROWS)
    last = {r["lang"]: r["last"] for r in drawn.groupBy("lang").agg(F.max("draw").alias("last")).collect()}
    if not last:
        return {}
    limit = F.create_map(*[F.lit(x) for pair in last.items() for x in pair])
    place = F.lit(1) + F.floor(unit(F.col("text"), seed=seed + 1) * F.greatest(F.lit(0), F.length("text") - SLICE + 1)).cast("int")
    picked = rows.filter(F.col("draw") <= limit[F.col("lang")]).select("lang", "draw", F.substring("text", place, F.lit(SLICE)).alias("text"))
    picked = picked.groupBy("lang", "draw").agg(F.min("text").alias("text"))
    texts = defaultdict(list)
    for r in picked.collect():
        texts[r["lang"]].append((r["draw"], r["text"]))
    found = {}
    for lang in sorted(texts):
        found[lang] = _prepared(" ".join(t for _, t in sorted(texts[lang])))
    return found


def _prepared(text: str) -> bytes:
    """Lower case, without ASCII signs and digits: what languages share says nothing."""
    return text.lower().encode("utf-8", "replace").translate(None, _SIGNS)


class Sizes:
    """Compressed sizes of a text with each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as zstd

        # matches from four bytes on, searched for greedily: words are short
        params = zstd.ZstdCompressionParameters(
            window_log=18, chain_log=16, hash_log=16, search_log=4, min_match=4, target_length=0,
            strategy=zstd.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        self.langs = list(dictionaries)
        self._compress = []
        for lang in self.langs:
            raw = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=params)
            self._compress.append(zstd.ZstdCompressor(compression_params=params, dict_data=raw).compress)

    def of(self, text: str) -> list[int]:
        data = _prepared(text)
        chunks = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)] or [b""]
        return [sum(map(len, map(compress, chunks))) for compress in self._compress]


def decide(sizes: list[int], langs: list[str]) -> tuple[str, float, float]:
    """The language of the smallest size (ties: the first by name), its probability, and the relative margin.

    The probability takes each compressed byte as 8 bits of evidence.
    """
    order = sorted(range(len(langs)), key=lambda i: (sizes[i], langs[i]))
    best = sizes[order[0]]
    rest = sum(math.exp(max(-700.0, (best - sizes[i]) * 8 * math.log(2))) for i in order)
    margin = (sizes[order[1]] - best) / best if len(order) > 1 else 1.0
    return langs[order[0]], 1 / rest, margin


def _judge(sizes: Sizes, text: str | None, min_margin: float) -> tuple[str, float, float, bool]:
    if not sizes.langs or not isinstance(text, str) or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0.0, False
    lang, probability, margin = decide(sizes.of(text), sizes.langs)
    return lang, probability, margin, margin >= min_margin


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows ``(doc_id, lang_pred, score, margin, certain)``, one for each row of ``docs``.

    ``certain`` is false if the relative margin between the two smallest sizes is below ``min_margin``,
    and for ``und``: a null text, a text without a letter, or no learned language.  Whole texts are
    compressed, in chunks.  Null ids are kept; repeated rows agree; an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(dictionaries)
        for batch in batches:
            out = [_judge(sizes, text, min_margin) for text in batch["text"]]
            found = pd.DataFrame(out, columns=["lang_pred", "score", "margin", "certain"])
            found.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield found.astype({"doc_id": "Int64"})

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(run, "doc_id long, lang_pred string, score double, margin double, certain boolean")


def predict(docs: DataFrame, modulus: int = 5, remainder: int = 0) -> DataFrame:
    """Rows ``(doc_id, held_out, lang_pred, score, margin, certain)``; held-out rows teach nothing."""
    held = held_out(F.col("doc_id"), modulus, remainder)
    found = identify(docs, learn(docs.filter(~held)))
    return found.withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score", "margin", "certain")


def keep_certain(docs: DataFrame, min_margin: float = MIN_MARGIN, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, whose language is certain, learnt from the ``lang`` of all.

    Each row is judged by its own text, whatever its id is; equal texts are judged alike.
    """
    dictionaries = learn(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(dictionaries)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([_judge(sizes, text, min_margin)[3] for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
