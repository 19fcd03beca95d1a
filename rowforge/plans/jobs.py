"""The three end-to-end jobs over a user's own files.

Each job reads its inputs, runs the operators and writes every output under
``out`` (paths may be local, HDFS or an object store); intermediates go to
the shared checkpoint folder.  Nothing is collected to the driver except
the small quality/count summaries the jobs return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.functions.text import clean_special_chars
from rowforge.operators import cleanse as cl
from rowforge.operators.relational import counts_of_groups, union_all
from rowforge.operators.splitting import write_split_by
from rowforge.plans import insurance
from rowforge.operators.aggregate import keyword_count
from rowforge.session import scratch_path
from rowforge.sinks import files as sinks
from rowforge.sources.csv import read_csv_strings, read_csv_typed
from rowforge.sources.lookup import read_lookup_list
from rowforge.sources.text import read_text_lines
from rowforge.streaming import chat as sc
from rowforge.streaming.ledger import run_to_ledger


def cleansing_job(spark: SparkSession, file1: str, file2: str, out: str,
                  header: str | None = None) -> dict:
    """Two delimited files of the insurance layout (file 1 dates yyyy-MM-dd,
    file 2 dd-MM-yyyy and padded) -> kept/rejected, merged, de-duplicated and
    split by business date.

    Outputs under ``out``: quality (json), rejected (parquet, with reason and
    file), merged (parquet), deduplicated (parquet, one folder per
    BusinessDate).  Returns the quality counts and dedup counts as dicts.
    """
    specs = {1: insurance.SPEC_FILE1, 2: insurance.SPEC_FILE2}
    kept, rejected, quality = [], [], []
    for v, path in ((1, file1), (2, file2)):
        lines = read_text_lines(spark, path)
        h = header if header is not None else cl.first_line(lines)
        store = scratch_path(spark, "jobs", f"cleansed{v}")
        k, r, counts = cl.cleanse_counted(lines, specs[v], h, store)
        kept.append(k)
        rejected.append(r.withColumn("file", F.lit(v)))
        quality.append(insurance.quality_row(spark, counts, v))
    sinks.write_json(union_all(*quality), f"{out}/quality")
    sinks.write_parquet(union_all(*rejected), f"{out}/rejected", mode="overwrite")
    merged = union_all(*kept)
    sinks.write_parquet(merged, f"{out}/merged", mode="overwrite")
    merged = spark.read.parquet(f"{out}/merged")
    # one shuffle for the distinct rows and their counts
    path = scratch_path(spark, "jobs", "grouped")
    merged.groupBy(*merged.columns).agg(F.count(F.lit(1)).alias("__n")).write.parquet(path)
    grouped = spark.read.parquet(path)
    write_split_by(grouped.drop("__n"), "BusinessDate", f"{out}/deduplicated")
    counts = counts_of_groups(grouped, "__n").first().asDict()
    return {"quality": [r.asDict() for r in spark.read.json(f"{out}/quality").collect()],
            "dedup": counts}


def enrichment_job(spark: SparkSession, plans_csv: str, custs_states: str, out: str,
                   jdbc: dict | None = None) -> DataFrame:
    """Typed plan CSV + mixed customer/state file -> cleaned plans (json and
    ``~`` csv), enriched view (parquet) and the per-protocol ranking
    (parquet, and a JDBC table when ``jdbc`` gives url/table/credentials)."""
    ds1 = read_csv_typed(spark, plans_csv, insurance.INSURANCE_SCHEMA,
                         store_path=scratch_path(spark, "jobs", "plans"),
                         escape=insurance.CSV_ESCAPE, nanValue=insurance.CSV_NAN)
    ds3 = ds1.na.drop("any")
    cleaned = ds3.withColumn("NetworkName", clean_special_chars("NetworkName"))
    sinks.write_json(cleaned.drop("DentalOnlyPlan"), f"{out}/cleaned_json")
    sinks.write_csv(cleaned.drop("DentalOnlyPlan"), f"{out}/cleaned_csv", header=True, sep="~")
    custs, states = insurance.customers_and_states(
        read_csv_strings(spark, custs_states, 5), store_path=scratch_path(spark, "jobs", "custs_states"))
    ds22 = insurance.insure_view(ds1)
    sinks.write_parquet(insurance.enriched_view(ds22, states, custs), f"{out}/enriched",
                        mode="overwrite")
    ranking = insurance.protocol_ranking(ds22, states, custs)
    sinks.write_parquet(ranking, f"{out}/ranking", mode="overwrite")
    if jdbc:
        sinks.write_jdbc(spark.read.parquet(f"{out}/ranking"), **jdbc)
    return spark.read.parquet(f"{out}/ranking")


def chat_job(spark: SparkSession, chat_dir: str, stopwords: str, out: str,
             checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """Chat lines (``id~text~type``) arriving as files in ``chat_dir`` ->
    customer words without stop words (parquet, ``out/words``) and their
    counts per batch (json, ``out/keywords``), both from one pass over each file.
    ``streaming.ledger.read_rows`` and ``read_sums`` read them, always at the same
    batch.  Each run processes the files that are new since the last run; the
    checkpoint that says which is kept beside the output unless ``checkpoint``
    names a folder."""
    stop = read_lookup_list(spark, stopwords)
    words = sc.words_without_stop(
        sc.customer_words(sc.text_stream(spark, chat_dir, max_files_per_trigger)), stop,
        null_aware=True)
    run_to_ledger(words, out, checkpoint or f"{out}/_checkpoint", "words", {"keywords": keyword_count},
                  formats={"keywords": "json"})
