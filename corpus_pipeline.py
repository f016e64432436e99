"""Training-corpus pipeline: five stages over the documents table, each one an operator of wayfare.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next stage's docs. All but the last return the columns of the
documents they got. Rows with null doc_ids, null or empty texts, repeated rows and
empty tables are handled as each stage's docstring says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import drop_stored, free_names, ship_package, stored, table
from wayfare.llm.decontaminate import contaminated
from wayfare.llm.jaccard_join import component_rows, text_digest
from wayfare.llm.language_id import predict, train
from wayfare.llm.packing import pack
from wayfare.llm.suffix_dedup import added_names, remove_repeats

PIECE_VOCABULARY = "piece_bpe_32k.model"
WORD_VOCABULARY = "word_bpe_49k.json"
#: Least share of the probability that the best language must have.
MIN_LANGUAGE_SCORE = 0.5


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rows of one Arrow batch in the stages; texts are long, and five stages share the workers' memory.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Gives the workers the code, and keeps batches small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose best language is less likely than all others together.

    Where no row has a language to learn from, only documents without a letter go.
    """
    prepare(spark)
    model = train(docs, vocabulary(PIECE_VOCABULARY))
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    best, score = free_names(docs.columns, "_lang_pred", "_lang_score")
    judged = predict(docs, model, (best, score))
    return judged.where((F.col(best) != "und") & (F.col(score) >= MIN_LANGUAGE_SCORE)).drop(best, score)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id stays.

    Documents without words are in no group and stay. Rows with the same doc_id and
    text are one document; of several texts with the smallest doc_id one stays. Null
    doc_ids come after all others.
    """
    prepare(spark)
    groups = stored(component_rows(docs), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_digest")).alias("head")
    heads = groups.where("n_shingles > 0").groupBy("component").agg(first).select("head.doc_id", "head.text_digest")
    staying = stored(heads.union(groups.where("n_shingles = 0").select("doc_id", "text_digest")).distinct(), "heads")
    drop_stored(groups)
    (digest,) = free_names(docs.columns, "_digest")
    keyed = docs.withColumn(digest, text_digest(F.col("text")))
    same = keyed["doc_id"].cast("long").eqNullSafe(staying["doc_id"]) & (keyed[digest] == staying["text_digest"])
    return keyed.join(staying, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*docs.columns)


def whole_characters(data: Column) -> Column:
    """UTF-8 bytes as text, without the halves of characters at cuts (nor any replacement character)."""
    return F.replace(F.make_valid_utf8(data.cast("string")), F.lit("\ufffd"), F.lit(""))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated 50-byte strings out of the texts; n_chars follows. Documents of which only white space is left go.

    Documents that lose nothing stay as they are, also null and empty ones.
    """
    prepare(spark)
    columns, (data, kept, spans) = docs.columns, added_names(docs)
    (no_text,) = free_names([*columns, data, kept, spans], "_no_text")
    cut = remove_repeats(docs.withColumn(no_text, F.col("text").isNull()))
    changed = F.size(spans) > 0
    text = F.when(changed, whole_characters(F.col(kept))).when(~F.col(no_text), F.col(data).cast("string"))
    out = cut.withColumn("text", text).where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*columns)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, edited or not, go. Rows with a null doc_id stay."""
    prepare(spark)
    found = stored(contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places for the tokens of all documents in sequences of 4096."""
    prepare(spark)
    return pack(docs, vocabulary(WORD_VOCABULARY))


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("suffix_array_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("best_fit_packing", pack_sequences),
]
#: Piece models and tokenizers have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        if at:
            drop_stored(before)
    return STAGES[-1][1](spark, docs, sf_dir)
