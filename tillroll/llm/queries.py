"""The registered queries of this subpackage: thin digests of what its operators return."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm import chat, fingerprints, licenses, mixing, ngram_join, packing, resampling, revisits, secrets, topk, toxicity, urls, whitening
from tillroll.llm.oracle import LLM_ORACLE  # noqa: F401
from tillroll.llm.shipping import ship


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_documents(_read(spark, sf_dir, "documents"))
    base = [kind for kind, *_ in secrets.BASE_RULES]

    def listed(spans):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, scale=64.0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized(_read(spark, sf_dir, "documents"))
    # the ids are digested where they are made, so that only numbers are written and dealt to the groups
    digested = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digested)


def captures(pages: DataFrame) -> DataFrame:
    """Archive records of ``pages``: a full response of every page and, a day later, a revisit of it.

    The revisit asks for a variant of the URL and answers with new dates; one in five has the entity tag of another
    version, one in seven only the date of modification, one in eleven no validator, and one in thirteen precedes the response.
    """
    number, day = F.col("page_id"), 86_400
    seen = F.timestamp_seconds(F.lit(1_700_000_000) + number * 60)
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    date = lambda at: F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    common = [F.lit("Date"), date(seen), F.lit("Last-Modified"), date(seen - F.expr("INTERVAL 3 DAYS"))]
    full = pages.select(
        (number * 2).alias("record_id"), "url", seen.alias("captured"), F.lit(200).alias("status"),
        F.create_map(*common, F.lit("ETag"), tag, F.lit("Content-Length"), F.length("html").cast("string"), F.lit("Server"), F.lit("a")).alias("headers"),
    )
    later = F.when(number % 13 == 0, seen - F.make_dt_interval(secs=F.lit(day))).otherwise(seen + F.make_dt_interval(secs=F.lit(day)))
    weak = F.concat(F.lit("W/"), F.when(number % 5 == 0, F.lit('"other"')).otherwise(tag))
    validator = (
        F.when(number % 11 == 0, F.create_map(F.lit("Age"), F.lit("1")))
        .when(number % 7 == 0, F.create_map(F.lit("Last-Modified"), date(seen - F.expr("INTERVAL 3 DAYS"))))
        .otherwise(F.create_map(F.lit("etag"), weak))
    )
    fresh = F.map_concat(validator, F.create_map(F.lit("date"), date(later), F.lit("Content-Length"), F.lit("0"), F.lit("Expires"), F.lit("0")))
    again = pages.select(
        (number * 2 + 1).alias("record_id"),
        F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")).alias("url"), later.alias("captured"),
        F.lit(304).alias("status"), fresh.alias("headers"),
    )
    return full.unionByName(again)


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = revisits.resolve(captures(_read(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("merged_headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return resolved.select("record_id", "canonical_url", "refers_to", "resolution", F.array_join(lines, "\n").alias("headers"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.held_out("doc_id")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels").where(~held_out))
    return model.score(docs).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted")
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"))
    return found.withColumn("differences", F.array_join("differences", "; "))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "'</s>[INST] ok [/INST]'"
    extra = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', {said}), (-7L, 1L, 'assistant', {said}) AS t(conv_id, turn, role, text)")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat.formatted(rows.unionByName(extra))
    read = out.select("conv_id", "formatted", chat.parsed(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words("text").alias("size"))
    mixed = mixing.mix(docs, F.col("size"), F.array("source"), F.col("doc_id"))
    of_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = {r.source: r.source_size for r in of_source.collect()}  # one row per source
    quota = mixing.targets(sizes)
    known = spark.createDataFrame([(s, sizes[s], quota[s]) for s in sizes], "source string, source_size long, target double")
    taken = F.col("size") * F.size("mix_copies")
    return mixed.join(F.broadcast(known), mixed["source"].eqNullSafe(known["source"])).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.neighbours(_read(spark, sf_dir, "documents"))
    lanes = F.col("lanes")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.packed(lanes).alias("fingerprint"),
        fingerprints.packed(F.col("edited_lanes")).alias("edited_fingerprint"),
        fingerprints.likeness(lanes, F.col("edited_lanes")).alias("near_edited"),
        fingerprints.likeness(lanes, F.col("next_lanes")).alias("near_next"),
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_read(spark, sf_dir, "documents"))


URL_RULES = [
    urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/")
]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    # the pages have no labels of their own; those that the stated rules decide are the labelled ones
    known = pages.select("url", urls.stated(urls.host(F.col("url")), urls.path(F.col("url")), URL_RULES)["verdict"].alias("label"))
    return urls.judged(pages, URL_RULES, known)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whitened(_read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resampled(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return drawn.drop("n_words")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_top_k": op2_top_k,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_toxicity": op5_toxicity,
    "op6_license_scan": op6_license_scan,
    "op7_chat_format": op7_chat_format,
    "op8_source_mix": op8_source_mix,
    "op9_fingerprints": op9_fingerprints,
    "op10_ngram_join": op10_ngram_join,
    "op11_url_filter": op11_url_filter,
    "op12_whitening": op12_whitening,
    "op13_resampling": op13_resampling,
    "pipeline": pipeline,
}
