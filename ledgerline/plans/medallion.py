"""Raw -> bronze -> silver movie flow with quarantine and repair.

Movies are derived from the test tables: one movie document per order,
with its priority, customer segment and status as its nested ``genres`` array.
Negative runtimes come from negative customer balances, budgets below the
quality floor from small order totals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from ledgerline.operators import mutation as M
from ledgerline.operators import projection as P
from ledgerline.operators import quality as Q
from ledgerline.operators.keys import with_row_index
from ledgerline.sources.tables import Tables

# Parse schema of a movie document (FIXTURES 1.2).  Ids are widened to
# bigint: at large scale the document ids derived from order keys exceed int.
MOVIE_SCHEMA = StructType([
    StructField("BackdropUrl", StringType()), StructField("Budget", DoubleType()),
    StructField("CreatedDate", TimestampNTZType()), StructField("Id", LongType()),
    StructField("ImdbUrl", StringType()), StructField("OriginalLanguage", StringType()),
    StructField("Overview", StringType()), StructField("PosterUrl", StringType()),
    StructField("Price", DoubleType()), StructField("ReleaseDate", DateType()),
    StructField("Revenue", DoubleType()), StructField("RunTime", IntegerType()),
    StructField("Tagline", StringType()), StructField("Title", StringType()),
    StructField("TmdbUrl", StringType()),
    StructField("genres", ArrayType(StructType([StructField("id", LongType()), StructField("name", StringType())]))),
])

SILVER_COLUMNS = ["movie_id", "title", "overview", "tagline", "budget", "revenue", "imdb_url", "tmdb_url",
                  "poster_url", "backdrop_url", "original_language_id", "release_date", "runtime", "price",
                  "created_time", "genre_id"]

DATASOURCE = "testdata/orders"
AS_OF = dt.datetime(2024, 1, 1, 0, 0, 0)


def movie_documents(t: Tables) -> DataFrame:
    """Raw movie JSON text, one document per order (what SRC1 yields per array element)."""
    # Bounded by the schema: two or three genres from the order's own columns, none for every seventh order.
    group = F.pmod("o_custkey", F.lit(50))
    genre = lambda i, n: F.struct(i.cast("bigint").alias("id"), n.alias("name"))
    genres = F.when(F.col("o_orderkey") % 7 == 0, F.array().cast("array<struct<id:bigint,name:string>>")).otherwise(F.array(
        genre(F.substring("o_orderpriority", 1, 1), F.col("o_orderpriority")),
        genre(100 + group, F.concat(F.lit("Segment "), group.cast("string"))),
        genre(200 + F.ascii("o_orderstatus"), F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")))))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    key = F.col("o_orderkey").cast("string")
    doc = F.struct(
        F.col("o_orderkey").alias("Id"),
        F.concat(F.lit("Order "), key).alias("Title"),
        F.col("o_orderpriority").alias("Overview"),
        F.col("o_orderstatus").alias("Tagline"),
        (F.col("o_totalprice") * 4).cast("decimal(18,2)").alias("Budget"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("Revenue"),
        F.concat(F.lit("https://imdb.example/"), key).alias("ImdbUrl"),
        F.concat(F.lit("https://tmdb.example/"), key).alias("TmdbUrl"),
        F.concat(F.lit("/poster/"), key, F.lit(".jpg")).alias("PosterUrl"),
        F.concat(F.lit("/backdrop/"), key, F.lit(".jpg")).alias("BackdropUrl"),
        F.lit("en").alias("OriginalLanguage"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ReleaseDate"),
        F.col("c_acctbal").cast("int").alias("RunTime"),
        (F.col("o_totalprice").cast("decimal(18,2)") * F.lit("0.001").cast("decimal(4,3)"))
        .cast("decimal(18,2)").alias("Price"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("CreatedDate"),
        genres.alias("genres"),
    )
    return o.select(F.to_json(doc).alias("value"))


def transform_raw(raw: DataFrame, datasource: str, as_of: dt.datetime | None = None, at: Column | None = None) -> DataFrame:
    """P1 ``transform_raw``: add ingest metadata; status starts as ``new`` (PRJ5, QA4).

    ``as_of`` pins the ingest time for reproducible runs; by default it is
    ``current_timestamp()``, evaluated once per query.  ``at`` gives a column instead.
    """
    ts: Column = at if at is not None else F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    return raw.select(F.lit(datasource).alias("datasource"), ts.alias("ingesttime"), "value",
                      F.lit("new").alias("status"), ts.cast("date").alias("p_ingestdate"))


def bronze(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    return transform_raw(movie_documents(t), DATASOURCE, as_of)


def transform_bronze(bronze_df: DataFrame) -> DataFrame:
    """P2 ``transform_bronze``: shred the JSON text to typed columns (JS1, PRJ4).

    Same rows as ``withColumn("nested_json", from_json(..)).select("value", "nested_json.*")``,
    but the struct is expanded by a generator (``inline_outer`` of a one-element
    array).  With the projection form, every later filter on a parsed field
    (the clean / quarantine split) is pushed below the projection and re-parses
    the document; a generator's output cannot be pushed through, so each
    document is parsed exactly once.
    """
    return bronze_df.select("value", F.inline_outer(F.array(F.from_json("value", MOVIE_SCHEMA))))


def refactor_silver(silver_df: DataFrame, dedupe: bool = True) -> DataFrame:
    """P2 ``refactor_silver``: rename, constant language key (QA6), genre ids (FN20),
    one row per raw value (AGG12; ``dedupe=False`` when the values are already distinct)."""
    out = silver_df.select(
        "value",
        F.col("Id").alias("movie_id"), F.col("Title").alias("title"), F.col("Overview").alias("overview"),
        F.col("Tagline").alias("tagline"), F.col("Budget").alias("budget"), F.col("Revenue").alias("revenue"),
        F.col("ImdbUrl").alias("imdb_url"), F.col("TmdbUrl").alias("tmdb_url"),
        F.col("PosterUrl").alias("poster_url"), F.col("BackdropUrl").alias("backdrop_url"),
        F.lit(1).alias("original_language_id"), F.col("ReleaseDate").alias("release_date"),
        F.col("RunTime").alias("runtime"), F.col("Price").alias("price"),
        F.col("CreatedDate").alias("created_time"), F.col("genres.id").alias("genre_id"),
    )
    return out.dropDuplicates(["value"]) if dedupe else out


def silver_all(t: Tables) -> DataFrame:
    """New bronze rows shredded and refactored (with ``value`` kept as the bronze join key)."""
    # Distinct raw text first (a one-column hash aggregate), then parse each
    # value once; deduping after parsing would shuffle the wide parsed rows.
    new = bronze(t).where(F.col("status") == "new").select("value").distinct()
    return refactor_silver(transform_bronze(new), dedupe=False)


def silver_clean(t: Tables) -> DataFrame:
    """The clean split written to silver (``value`` dropped, S26)."""
    clean, _, _ = Q.split_clean_quarantine(silver_all(t))
    return clean.select(*SILVER_COLUMNS)


def silver_quarantine(t: Tables) -> DataFrame:
    """The quarantined split."""
    _, quarantine, _ = Q.split_clean_quarantine(silver_all(t))
    return quarantine.select(*SILVER_COLUMNS)


def silver_repaired(t: Tables) -> DataFrame:
    """Quarantined rows repaired in one pass and merged into silver, one row per value.

    Union by name (SET3) of the clean rows and the repaired quarantine;
    unclassified rows (NULL runtime or budget) stay out of silver.  The
    data flow's ``first`` per value (AGG13, :func:`dedupe_first`) is not
    repeated: both inputs come from the same value-distinct rows and the two
    splits are disjoint, so every value already occurs once.
    """
    s = silver_all(t)
    # clean UNION repair(quarantine) in one pass: the splits are disjoint and
    # the repair leaves clean rows unchanged, so repairing every classified
    # row gives the same rows without reading the parsed data twice.
    classified = s.where(F.coalesce(Q.clean_predicate(), F.lit(False)) | F.coalesce(Q.quarantine_predicate(), F.lit(False)))
    return Q.repair(classified).select(*SILVER_COLUMNS)


def status_write_back(t: Tables) -> DataFrame:
    """P2/P3 status lifecycle on bronze (QA4, S22).

    Clean rows become ``loaded``, quarantined ``quarantined``; rows that fit
    neither split are marked ``unclassified`` instead of vanishing.  The
    reference merges silver's classification back onto bronze by raw value
    (DML3).  Every silver row is derived from its own bronze value, so the
    same status follows from classifying each new bronze row directly: a
    map-only plan with no shuffle or join, whatever the table size.  The
    keyed merge (:func:`ledgerline.operators.mutation.update_matched`) is used
    where updates come from another table (``plans.flows``).
    """
    return classify_bronze(bronze(t))


def status_merge(t: Tables) -> DataFrame:
    """DML3/JN14: the same write-back as the keyed merge of silver's labels onto bronze."""
    labels = Q.classify(silver_all(t), "new_status").select("value", "new_status")
    return M.update_matched(bronze(t), labels, "value", "status", source_col="new_status")


def defect_counts(t: Tables) -> DataFrame:
    """QA2 over all silver rows."""
    return Q.defect_counts(silver_all(t))


def defect_counts_on_the_way(t: Tables) -> DataFrame:
    """QA2/QA4: the counts that the write of the clean rows makes on its way, without a scan of their own.

    The rows go to a sink that keeps nothing here; ``flows.bronze_to_silver``
    does the same with silver.  Zeros if there is no row.
    """
    seen = Observation()
    clean, _, _ = Q.split_clean_quarantine(silver_all(t).observe(seen, *Q.defect_metrics()))
    clean.write.format("noop").mode("overwrite").save()
    counts = seen.get
    return t.spark.createDataFrame([tuple(int(counts.get(n) or 0) for n in Q.METRICS)], ", ".join(f"{n} long" for n in Q.METRICS))


def genre_lookup_merge(t: Tables, before: str = "1997-01-01") -> DataFrame:
    """QA5 over two batches: the lookup of the earlier documents plus what the later ones add to it."""
    docs = bronze(t).select("value", F.from_json("value", "ReleaseDate DATE").ReleaseDate.alias("day"))
    parsed = lambda d: Q.lookup_genres(d.select(F.inline_outer(F.array(F.from_json("value", GENRES_ONLY)))))
    early = parsed(docs.where(F.col("day") < F.lit(before).cast("date")))
    late = parsed(docs.where(~F.coalesce(F.col("day") < F.lit(before).cast("date"), F.lit(False))))
    return early.unionByName(late.join(early, ["id", "name"], "left_anti"))


def genre_texts(t: Tables) -> DataFrame:
    """FN21: the genre ids of clean silver rows as list text."""
    return silver_clean(t).select("movie_id", P.array_text("genre_id").alias("genre_ids"))


def classify_bronze(bronze_df: DataFrame) -> DataFrame:
    """Bronze rows with ``status`` set from their own parsed value (new rows only)."""
    parsed = bronze_df.select("*", F.inline_outer(F.array(F.from_json("value", MOVIE_SCHEMA))))
    runtime, budget = F.col("RunTime"), F.col("Budget")
    label = (F.when((runtime >= 0) & (budget >= Q.MIN_BUDGET), F.lit(Q.CLEAN))
             .when((runtime < 0) | (budget < Q.MIN_BUDGET), F.lit(Q.QUARANTINED))
             .otherwise(F.lit(Q.UNCLASSIFIED)))
    out = parsed.withColumn("status", F.when(F.col("status") == "new", label).otherwise(F.col("status")))
    return out.select(*bronze_df.columns)


# The genre lookup needs one field; a pruned parse schema (S31) makes the JSON
# reader skip building every other column.
GENRES_ONLY = StructType([MOVIE_SCHEMA["genres"]])


def genre_lookup(t: Tables) -> DataFrame:
    """QA5 genres lookup from the new bronze rows (AGG14/AGG15), parsing only ``genres``."""
    new = bronze(t).where(F.col("status") == "new").select("value")
    parsed = new.select(F.inline_outer(F.array(F.from_json("value", GENRES_ONLY))))
    return Q.lookup_genres(parsed)


def language_lookup(t: Tables) -> DataFrame:
    """QA5 languages, general form: distinct document languages with dense ids.

    The reference hard-codes ``(1, 'English')`` (S32,
    :func:`ledgerline.operators.quality.lookup_languages_constant`).
    """
    langs = t.documents.select(F.col("lang").alias("language")).where(F.col("language").isNotNull()).distinct()
    return with_row_index(langs, ["language"], "id").select(F.col("id").cast("int").alias("id"), "language")


def silver_lake_form(silver: DataFrame) -> DataFrame:
    """The data-flow (lake) schema of silver (S25): ``created_date`` DATE and
    ``genre_id`` as list text, instead of a timestamp and an int array."""
    return silver.select(*[c for c in silver.columns if c not in ("created_time", "genre_id")],
                         F.col("created_time").cast("date").alias("created_date"),
                         F.to_json("genre_id").alias("genre_id"))
