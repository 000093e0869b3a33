"""From raw documents to token files: language, near-duplicates, benchmarks, mixture, ids.

Every stage takes the documents its predecessor kept and gives them back with the columns of
`documents`; the last gives what the token files hold. `run` writes and rereads each result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daywise.llm.decontaminate import contaminated
from daywise.llm.language_id import CHANCE, UNKNOWN, language, train
from daywise.llm.mixing import mix
from daywise.llm.queries import tokenizer_path
from daywise.llm.shared import table, word_count
from daywise.llm.simhash import near_duplicates
from daywise.llm.token_output import read_index, write_tokens
from daywise.session import materialise, new_folder

# A document is dropped for an overlap with a benchmark of so many words; shorter items are everyday phrases.
LEAST_OVERLAP = 5


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which no language is recognised: null or without a letter, or at chance.

    A document is at chance if the classifiers of the best language's codeword say no more about it than nothing, however many languages there
    are. The model learns from the rows with text and language; without any, no document stays. Repeated rows are judged
    alike; an empty table stays empty.
    """
    model = train(docs)
    if not model.languages:
        return docs.filter("false")
    name = fresh(docs, "_found")
    found = docs.withColumn(name, language(model, F.col("text")))
    return found.filter((F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.loss") < CHANCE)).select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group: of least id, nulls last, then by hash of the text and of the whole row.

    Rows with neither id nor text stay; a null text beside an id is one of no words, and all such are a group. Of rows
    equal throughout one stays. An empty table stays empty. The keys of rows that go are written first; texts are compared
    with these alone.
    """
    told = F.col("doc_id").isNotNull() | F.col("text").isNotNull()
    key = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("text_hash"), F.xxhash64(*docs.columns).alias("row_hash"),
    )
    name = fresh(docs, "_key")
    keyed = docs.filter(told).withColumn(name, key)
    groups = near_duplicates(keyed, name)
    gone = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct()
    kept = keyed.join(materialise(gone, "gone"), name, "left_anti")
    several = materialise(keyed.groupBy(name).count().filter("count > 1").select(name), "several")
    rest = docs.filter(~told)
    if several.isEmpty():
        return kept.select(docs.columns).union(rest)
    once = kept.join(several, name, "left_semi").dropDuplicates([name])
    return kept.join(several, name, "left_anti").union(once).select(docs.columns).union(rest)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that overlap with a benchmark item in `LEAST_OVERLAP` words or more, told apart by a hash of id and text.

    Null and empty texts overlap with nothing and stay, also where the id is null; repeated rows go or stay together. An empty
    table, or benchmark, drops nothing. The keys of rows that go are written first.
    """
    name = fresh(docs, "_key")
    keyed = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    leaks = contaminated(keyed, table(spark, sf_dir, "benchmark"), name).filter(F.col("overlap_words") >= LEAST_OVERLAP)
    leaks = materialise(leaks.select(F.col("doc_id").alias(name)).distinct(), "leaks")
    return keyed.join(leaks, name, "left_anti").select(docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it; a document taken twice is two rows.

    A null text has no words and is never taken, nor is an empty one; a null source is a source of its own. Rows that share id, source
    and number of words are taken equally often. An empty table stays empty.
    """
    words, copy = fresh(docs, "_words"), fresh(docs, "_copy")
    own = {c: fresh(docs, f"_taken_{c}") for c in ("doc_id", "source", "size", "copies")}
    taken = mix(docs).filter("copies > 0").select(*own).distinct().toDF(*own.values())
    same = F.col("doc_id").eqNullSafe(F.col(own["doc_id"])) & F.col("source").eqNullSafe(F.col(own["source"]))
    sized = docs.withColumn(words, word_count("text"))
    chosen = sized.join(taken, same & (F.col(words) == F.col(own["size"])))
    return chosen.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(own["copies"])))).select(docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files; doc_id, start, n_tokens and ids_crc32 of each document, read back.

    A null text is empty and gives the end id alone; rows without an id come first, repeated rows follow each other. An empty
    table gives no rows.
    """
    path = new_folder(spark, "token-blocks")
    write_tokens(docs, path, tokenizer_path())
    return read_index(spark, path)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# No SQL can express trained models, fingerprints and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
