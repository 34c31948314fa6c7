"""The corpus pipeline: language ID, near duplicates, repeated passages, decontamination, mixing.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrain.llm.common import append_columns, free_name, materialize
from pricegrain.llm.decontaminate import contaminated
from pricegrain.llm.language_id import UNDETERMINED, with_language
from pricegrain.llm.mixing import mix
from pricegrain.llm.repeats import remove_repeats
from pricegrain.llm.simhash import near_duplicates
from pricegrain.session import attach

#: Words from which a benchmark item is a passage.
PASSAGE = 5
#: A text is of no language that was learnt from this much beyond the distance that this share of its documents keep.
USUAL, STRANGE_BEYOND = 0.9, 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, in a language that was learnt from their lang column. Rows without a doc_id, which no later decision could name, go too.

    How far a text may be from a language follows from the documents of that language that are told as such.
    Noise of few letters (about 40) can be as near as a clean text, and stays. Each row is judged alone, repeated ids too.
    """
    names = tuple(free_name(docs, n) for n in ("said", "score", "distance"))
    said, _, distance = names
    judged = materialize(with_language(docs.filter("doc_id is not null"), docs, F.lit(True), names), "said").filter(F.col(said) != UNDETERMINED)
    told = judged.filter(F.col("lang").cast("string") == F.col(said))
    # one row for each language that was learnt, of which with_language allows a bounded number
    limits = {r[0]: r[1] for r in told.groupBy(said).agg(F.percentile_approx(distance, USUAL) + STRANGE_BEYOND).collect()}
    limit = F.coalesce(*[F.when(F.col(said) == name, F.lit(far)) for name, far in limits.items()], F.lit(1.0))  # a language of which no document is told as such has no limit
    return judged.filter(F.col(distance) < limit).select(docs.columns)


def one_row_an_id(docs: DataFrame) -> DataFrame:
    """Of repeated rows of an id the one of least text, then of least other columns."""
    repeated = materialize(docs.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if not repeated.head(1):
        return docs
    order = ["text", *(f.name for f in docs.schema if f.name != "text" and not isinstance(f.dataType, (T.MapType, T.VariantType)))]
    least = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.struct(*order)).alias("row")).select("row.*")
    return docs.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(least)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document of smallest doc_id; of repeated rows of an id that of least text. Rows without an id go.

    What goes is joined to the documents, so that texts are only shuffled when that list is too long to broadcast.
    """
    docs = one_row_an_id(docs.filter("doc_id is not null"))
    gone = materialize(near_duplicates(docs).filter(F.col("doc_id") != F.col("component_id")).select("doc_id"), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; characters cut by a passage's end go too, and so do texts that are nothing else.

    Rows of one id, and rows without, count as documents of their own. Null texts become empty ones.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]

    def decode(batches):
        for batch in batches:
            texts = [k.decode("utf-8", "ignore") for k in batch["kept"]]
            yield {"text": texts, "n_chars": [len(t) for t in texts]}

    cut = remove_repeats(docs, rest).filter((F.col("n_removed") < F.col("n_bytes")) | (F.col("n_removed") == 0))
    new = append_columns(cut.select("doc_id", "carried", "kept"), ["kept"], {"text": "string", "n_chars": "long"}, decode)
    return new.select(*[F.col(c) if c in ("doc_id", "text", "n_chars") else F.col("carried").getField(c).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Rows without an id, or with an empty text, hold none; of an id with a passage in one row all rows go.

    An item of fewer than PASSAGE words is a phrase that clean documents use as well, and takes none along.
    """
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter(F.round(F.col("n_equal") / F.col("item_share")) >= PASSAGE)
    leaks = materialize(found.select("doc_id").distinct(), "leaks")
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as a plan: how many words it takes of each document that is left, as ``mix`` defines for nulls, repeated ids and ties."""
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("mix", mixing),
]

#: SQL can express neither n-gram profiles nor SimHash components nor spaced seeds.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = attach(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
