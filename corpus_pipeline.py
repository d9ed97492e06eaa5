"""Documents to packed training sequences, stage by stage.

Each stage takes what the one before has kept, with the columns of documents, and decides on its own
input; the last returns the pieces of the packed documents. Ids may be repeated or NULL.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm import langid, packing, pii, quality, simhash
from tradewind.operators.lineage import checkpoint_folder, written

MIN_LANGUAGE_SHARE = 0.5
MIN_KNOWN = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the limits or lie far outside their group go."""
    return quality.keep_good(docs)


def _renamed(docs: DataFrame) -> dict[str, str]:
    """Names of the columns within a stage, so that they can't clash with the stage's own."""
    return {name: f"_c{i}" for i, name in enumerate(docs.columns)}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, without a language that holds half of them, or with
    most words in no known language, go.

    ``lang`` stays as it is: only the decision whether the text is prose of a known language counts.
    Models are learned from the labelled documents that aren't held out, or from all labelled ones if
    there are no others. Without any labelled document there is no known language, and only documents
    without a letter go.
    """
    models = (langid.train(docs.where(~langid.held_out("doc_id"))) or langid.train(docs))
    if models is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    names = _renamed(docs)
    judged = langid.predict(docs.toDF(*names.values()), models, text=names["text"],
                            keep=tuple(names.values()))
    share = F.coalesce(F.try_element_at("languages", F.lit(1))["share"], F.lit(0.0))
    return judged.where((F.col("lang_pred") != langid.UNDETERMINED)
                        & (share >= MIN_LANGUAGE_SHARE) & (F.col("known") >= MIN_KNOWN)).select(
        *(F.col(new).alias(name) for name, new in names.items()))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group the document with the smallest id stays.

    Rows are told apart by id and text, NULL ids last and a NULL text as an empty one; of rows equal
    in both the first by all columns stays.
    """
    names = _renamed(docs)
    inner = docs.toDF(*names.values())
    row_id, digest = F.col(names["doc_id"]), F.sha2(F.coalesce(names["text"], F.lit("")), 256)
    key = F.struct(row_id.isNull().alias("unknown"), row_id.alias("id"), digest.alias("digest"))
    keyed = inner.select("*", key.alias("_key"))
    found = simhash.near_duplicates(keyed.select(F.col("_key").alias("key"),
                                                 F.col(names["text"]).alias("text")), row_id="key")
    first = written(found.select("component_id").distinct())
    # Equal rows of one document: by all columns but the text, which hardly ever differ.
    others = [F.col(new) if _sortable(kind) else F.col(new).cast("string")
              for (name, kind), new in zip(docs.dtypes, names.values(), strict=True)
              if name != "text"]
    order = Window.partitionBy("_key").orderBy(*others, F.col(names["text"]).isNull())
    return (keyed.join(first, F.col("_key") == F.col("component_id"), "left_semi")
            .withColumn("_place", F.row_number().over(order)).where("_place = 1")
            .select(*(F.col(new).alias(name) for name, new in names.items())))


def _sortable(kind: str) -> bool:
    return not kind.startswith(("map", "variant"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span is replaced by the name of its kind; n_chars is counted anew."""
    return pii.mask(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the pieces of all documents and their places in the sequences."""
    return packing.pack(packing.token_pieces(docs))


STAGES = [("quality_rules", quality_rules), ("language_id", language_id),
          ("simhash_dedup", simhash_dedup), ("pii", mask_personal_data),
          ("best_fit_packing", pack_documents)]

# Robust estimates, mixtures and fingerprints have no SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage is written as Parquet to the shared folder and read again, so
    none is computed twice, and a lost executor repeats tasks of the stage at hand only."""
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
