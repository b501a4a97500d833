"""Sources, sinks, contracts, projections, scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions import expressions as X
from riskframe.operators import contracts, profile, splits
from riskframe.plans.bindings import (
    ACCOUNT_ROLES,
    BILLS,
    DELAYS,
    PAYMENTS,
    RUN_CTES,
    accounts,
    lines,
    panel,
    run_heads,
    run_metrics,
    run_tags,
    table,
    wide_runs,
    with_,
)
from riskframe.plans.registry import query
from riskframe.roles import numeric_columns, split_features_target
from riskframe.session import fresh_path, materialise
from riskframe.sources import artifacts, runstore, tables

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


# --- sources and sinks ----------------------------------------------------------------


@query("io01_titled_text_scan", "SELECT user_id, event_type, value FROM events")
def io01(spark, sf):
    path = fresh_path(spark, "titled")
    events = table(spark, sf, "events").select(*EVENT_SCHEMA.names)
    tables.write_titled_text(events, path, title="exported events")
    return tables.read_titled_text(spark, path, EVENT_SCHEMA, id_col="event_id")


@query(
    "io01_titled_text_head",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, event_type FROM events
       UNION ALL SELECT 'user_id', 'event_type' UNION ALL SELECT 'exported events', NULL""",
)
def io01b(spark, sf):
    """Data lines that equal the header or the title stay."""
    path = fresh_path(spark, "titled")
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id"), "event_type")
    tables.write_titled_text(events, path, title="exported events")
    alike = spark.createDataFrame([("another title",), ("another header",), ("user_id,event_type",), ("exported events",)], "value string")
    alike.coalesce(1).write.mode("append").text(path)
    return tables.read_titled_text(spark, path, events.schema)


@query("io02_normalised_names", "SELECT event_id, user_id, value FROM events")
def io02(spark, sf):
    raw = table(spark, sf, "events").select("event_id", "user_id", "value").toDF(" Event ID", "User Id", "VALUE ")
    return tables.normalise_columns(raw)


@query("io03_positional_rename", "SELECT c_custkey AS x1, c_acctbal AS x2, c_mktsegment AS x3 FROM customer")
def io03(spark, sf):
    return tables.rename_by_position(
        table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), ["x1", "x2", "x3"]
    )


@query("io04_parquet_scan", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 5000")
def io04(spark, sf):
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_acctbal", T.DoubleType())])
    return tables.read_parquet(spark, f"{sf}/supplier.parquet", schema).where(F.col("s_acctbal") > 5000)


@query("io05_csv_round_trip", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def io05(spark, sf):
    path = fresh_path(spark, "csv")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    tables.write_csv(part, path)
    return tables.read_csv(spark, path, part.schema)


@query(
    "io06_parquet_sink",
    "SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang",
)
def io06(spark, sf):
    path = fresh_path(spark, "clean")
    tables.write_parquet(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), path, partition_by=["lang"])
    return spark.read.parquet(path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query(
    "io07_json_artifact",
    """SELECT source, lang, count(*) AS n, max(n_chars) AS longest FROM documents GROUP BY source, lang""",
)
def io07(spark, sf):
    path = fresh_path(spark, "json")
    per = table(spark, sf, "documents").groupBy("source", "lang").agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.max("n_chars").alias("longest")).alias("summary")
    )
    artifacts.write_json_lines(per, path)
    back = artifacts.read_json_lines(spark, path, per.schema)
    return back.select("source", "lang", "summary.n", "summary.longest")


@query(
    "io09_consolidated_runs",
    with_(*RUN_CTES)
    + """SELECT run_id, run_name, CASE WHEN suppkey % 13 = 0 THEN '' ELSE model_family END AS model_family, stage,
         search_type, roc_auc, f1_macro, precision_macro, recall_macro, accuracy, cv_roc_auc_mean, cv_roc_auc_std,
         cv_f1_mean, cv_f1_std, training_time_s, inference_latency_ms
         FROM runs WHERE stage = 'tune' ORDER BY roc_auc DESC NULLS LAST, run_id""",
)
def io09(spark, sf):
    return runstore.consolidated(run_heads(spark, sf), run_metrics(spark, sf), run_tags(spark, sf), stage="tune")


@query(
    "io10_metric_log_scan",
    with_("per_supplier_year", "run_metrics") + "SELECT key, value, ts, CAST(step AS BIGINT) AS step, run_id FROM run_metrics",
)
def io10(spark, sf):
    path = fresh_path(spark, "metriclogs")
    runstore.write_metric_logs(run_metrics(spark, sf), path)
    return runstore.read_metric_logs(spark, path)


def run_rows(spark, sf):
    heads = wide_runs(spark, sf).where(F.col("training_time_s").isNotNull())
    name = F.col("run_name")
    maps = runstore.run_record(
        name,
        tags={"model_family": F.col("model_family"), "framework": F.lit("spark"), "dimred_method": F.col("dimred_method")},
        metrics={m: F.col(m) for m in runstore.METRICS},
        params={"model_name": F.col("model_name"), "seed": F.lit(42), "cv_folds": F.lit(5)},
        clf_params={"max_depth": F.col("suppkey") % 4},
    )
    return heads.select("run_id", "experiment", "run_name", "start_time", *maps)


@query(
    "io11_append_runs",
    with_(*RUN_CTES)
    + """SELECT run_id, stage, search_type, '' AS baseline_run_id, CAST(suppkey % 4 AS VARCHAR) AS max_depth, roc_auc
         FROM runs WHERE training_time_s IS NOT NULL AND stage = 'dimred'""",
)
def io11(spark, sf):
    path = fresh_path(spark, "runs")
    rows = run_rows(spark, sf)
    runstore.append_runs(rows.where(F.col("experiment") == "exp0"), path)
    runstore.append_runs(rows.where(F.col("experiment") != "exp0"), path)
    tags, params = F.col("tags"), F.col("params")
    return runstore.read_runs(spark, path, stage="dimred").select(
        "run_id",
        "stage",
        tags["search_type"].alias("search_type"),
        tags["baseline_run_id"].alias("baseline_run_id"),
        params["clf__max_depth"].alias("max_depth"),
        F.col("metrics")["roc_auc"].alias("roc_auc"),
    )


@query(
    "io12_markdown_table",
    with_(*RUN_CTES)
    + """, top AS (SELECT run_id, stage, roc_auc, row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, run_id) AS rn
                   FROM runs)
         SELECT CAST(1 AS INTEGER) AS position, '| run_id | stage | roc_auc |' AS line
         UNION ALL SELECT 2, '|---|---|---|'
         UNION ALL SELECT CAST(rn + 2 AS INTEGER), '| ' || run_id || ' | ' || stage || ' | '
                          || printf('%.4f', roc_auc) || ' |' FROM top""",
)
def io12(spark, sf):
    path = fresh_path(spark, "markdown")
    report = wide_runs(spark, sf).select("run_id", "stage", "roc_auc")
    lines_ = artifacts.markdown_table(report, [F.desc_nulls_last("roc_auc"), F.asc("run_id")])
    artifacts.write_markdown(lines_, path)
    return lines_


#: Order keys in a file of the checksum queries, and bytes of its blocks.
FILE_KEYS, FILE_BLOCK = 1024, 4096
TITLE, HEADER = "exported orders", "key|customer|status"

FILES_SQL = f"""lines AS (SELECT o_orderkey // {FILE_KEYS} AS bucket, o_orderkey AS k, o_orderkey || '|' || o_custkey || '|' AS head,
    o_orderstatus AS good, CASE WHEN o_orderkey % 5000 = 1 THEN lower(o_orderstatus) ELSE o_orderstatus END AS bad FROM orders),
  files AS (SELECT bucket, '{TITLE}' || chr(10) || '{HEADER}' || chr(10) || string_agg(head || good || chr(10), '' ORDER BY k) AS good,
    '{TITLE}' || chr(10) || '{HEADER}' || chr(10) || string_agg(head || bad || chr(10), '' ORDER BY k) AS bad FROM lines GROUP BY bucket)"""


def order_lines(spark, sf, altered: bool = False):
    """(bucket, at, value): lines of the files that hold the orders, a file per FILE_KEYS keys.

    Where ``altered``, the status of some orders is in small letters.
    """
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    if altered:
        status = F.when(key % 5000 == 1, F.lower(status)).otherwise(status)
    rows = table(spark, sf, "orders").select(
        F.floor(key / FILE_KEYS).alias("bucket"), key.alias("at"), F.concat_ws("|", key.cast("string"), F.col("o_custkey").cast("string"), status).alias("value")
    )
    heads = F.array(*[F.struct(F.lit(at).cast("long").alias("at"), F.lit(text).alias("value")) for at, text in ((-2, TITLE), (-1, HEADER))])
    return rows.unionByName(rows.select("bucket").distinct().select("bucket", F.inline(heads)))


def order_files(spark, sf, altered: bool = False) -> str:
    """The lines as files in order of their keys, one folder and file per bucket."""
    path = fresh_path(spark, "files")
    ordered = order_lines(spark, sf, altered).repartition("bucket").sortWithinPartitions("bucket", "at")
    ordered.select("bucket", "value").write.partitionBy("bucket").text(path)
    return path


def given_contents(spark, sf):
    """(file_name, content) of the unaltered files, made from the table and not from files; a file has few keys."""
    lines_ = F.sort_array(F.collect_list(F.struct("at", "value")))
    content = F.concat(F.array_join(F.transform(lines_, lambda x: x["value"]), "\n"), F.lit("\n"))
    return order_lines(spark, sf).groupBy("bucket").agg(content.alias("content")).select(
        F.concat(F.lit("bucket="), F.col("bucket").cast("string")).alias("file_name"), "content"
    )


def by_folder(checksums):
    """File names without the part that differs from write to write."""
    return checksums.withColumn("file_name", F.regexp_extract("file_name", "^([^/]*)", 1))


def bucket_of_file():
    return F.regexp_extract("file_name", "=(.*)$", 1).cast("long").alias("bucket")


@query(
    "io14_file_checksums",
    f"""WITH {FILES_SQL} SELECT bucket, CAST(length(bad) AS BIGINT) AS n_bytes, sha256(bad) AS sha256, good = bad AS matches FROM files""",
)
def io14(spark, sf):
    """Files of which some were altered after their digests were given."""
    found = by_folder(artifacts.file_checksums(spark, order_files(spark, sf, altered=True), pattern="part-*"))
    manifest = given_contents(spark, sf).select("file_name", F.sha2("content", 256).alias("sha256"))
    wrong = artifacts.checksum_mismatches(found, manifest).select("file_name", F.lit(False).alias("same"))
    return found.join(wrong, "file_name", "left").select(bucket_of_file(), "n_bytes", "sha256", F.coalesce("same", F.lit(True)).alias("matches"))


@query(
    "io14_block_checksums",
    f"""WITH {FILES_SQL}, cut AS (SELECT bucket, good, bad, unnest(range(0, (length(bad) + {FILE_BLOCK - 1}) // {FILE_BLOCK})) AS block FROM files),
        blocks AS (SELECT bucket, block, substr(good, block * {FILE_BLOCK} + 1, {FILE_BLOCK}) AS good,
          substr(bad, block * {FILE_BLOCK} + 1, {FILE_BLOCK}) AS bad FROM cut)
        SELECT bucket, block, CAST(length(bad) AS BIGINT) AS n_bytes, sha256(bad) AS sha256, good = bad AS matches FROM blocks""",
)
def io14b(spark, sf):
    """The altered blocks are named, not only their files."""
    blocks = artifacts.block_checksums(spark, order_files(spark, sf, altered=True), pattern="part-*", block_bytes=FILE_BLOCK)
    found = materialise(by_folder(blocks), "digests")
    last = F.floor((F.length("content") - 1) / FILE_BLOCK)
    manifest = given_contents(spark, sf).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    part = F.substring("content", (F.col("block") * FILE_BLOCK + 1).cast("int"), F.lit(FILE_BLOCK))
    manifest = manifest.select("file_name", "block", F.sha2(part, 256).alias("sha256"))
    wrong = artifacts.changed_blocks(found, manifest).select("file_name", "block", F.lit(False).alias("same"))
    out = found.join(wrong, ["file_name", "block"], "left")
    return out.select(bucket_of_file(), "block", "n_bytes", "sha256", F.coalesce("same", F.lit(True)).alias("matches"))


@query(
    "io14_block_file_digests",
    f"""WITH {FILES_SQL}, cut AS (SELECT bucket, good, unnest(range(0, (length(good) + {FILE_BLOCK - 1}) // {FILE_BLOCK})) AS block FROM files)
        SELECT bucket, CAST(length(any_value(good)) AS BIGINT) AS n_bytes, count(*) AS n_blocks,
          sha256(string_agg(sha256(substr(good, block * {FILE_BLOCK} + 1, {FILE_BLOCK})), '' ORDER BY block)) AS digest FROM cut GROUP BY bucket""",
)
def io14c(spark, sf):
    """One digest per file over the digests of its blocks."""
    blocks = artifacts.block_checksums(spark, order_files(spark, sf), pattern="part-*", block_bytes=FILE_BLOCK)
    return artifacts.file_digests(by_folder(blocks)).select(bucket_of_file(), "n_bytes", "n_blocks", "digest")


# --- contracts ------------------------------------------------------------------------

CHECK = """SELECT {0} AS position, '{1}' AS "check", 'fatal' AS severity, {2} = {3} AS passed,
           CAST({2} AS BIGINT) AS observed, CAST({3} AS BIGINT) AS expected FROM f"""


@query(
    "ct01_row_count",
    "SELECT 'row_count' AS \"check\", count(*) AS observed, CAST(count(*) = 15000 AS BOOLEAN) AS passed FROM orders",
)
def ct01(spark, sf):
    checks = contracts.Contract(target="target", n_columns=8, n_rows=15000).check(accounts(spark, sf), only=["row_count"])
    return checks.select("check", "observed", "passed")


@query(
    "ct04_missing_cells",
    """SELECT 'no_missing' AS "check", count(*) FILTER (k IS NULL) AS observed, count(*) FILTER (k IS NULL) = 0 AS passed
       FROM (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE value END AS k FROM events)""",
)
def ct04(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    checks = contracts.Contract(target="value", n_columns=2).check(events, only=["no_missing"])
    return checks.select("check", "observed", "passed")


@query(
    "ct05_duplicate_rows",
    with_("lines")
    + """SELECT 'no_duplicates' AS "check", CAST(sum(n - 1) AS BIGINT) AS observed, sum(n - 1) = 0 AS passed
         FROM (SELECT count(*) AS n FROM lines GROUP BY quantity, line, flag, status, discount)""",
)
def ct05(spark, sf):
    part = lines(spark, sf).select("quantity", "line", "flag", "status", "discount")
    checks = contracts.Contract(target="status", n_columns=5).check(part, only=["no_duplicates"])
    return checks.select("check", "observed", "passed")


@query(
    "ct06_domain_codes",
    with_("accounts")
    + """SELECT 'month' AS "column", month AS bad_code, count(*) AS n FROM accounts WHERE month > 10 GROUP BY month
         UNION ALL SELECT 'priority', priority, count(*) FROM accounts WHERE priority > 3 GROUP BY priority""",
)
def ct06(spark, sf):
    allowed = {"month": list(range(1, 11)), "priority": [1, 2, 3], "absent": [0]}
    return contracts.domain_violations(accounts(spark, sf), allowed)


@query(
    "ct07_contract",
    with_("lines")
    + """, f AS (SELECT sum(n) AS rows, sum(n - 1) AS copies FROM
           (SELECT count(*) AS n FROM lines GROUP BY quantity, price, discount, tax, line, flag, status, target)) """
    + " UNION ALL ".join(
        [
            CHECK.format(1, "row_count", "rows", 60000),
            CHECK.format(2, "column_count", 8, 8),
            CHECK.format(3, "target_present", 1, 1),
            CHECK.format(4, "no_missing", 0, 0),
            CHECK.format(5, "no_duplicates", "copies", 0),
        ]
    )
    + """ UNION ALL SELECT 6, 'domain:line:' || line, 'warning', false, count(*), 0 FROM lines WHERE line > 5
          GROUP BY line""",
)
def ct07(spark, sf):
    contract = contracts.Contract(target="target", n_columns=8, n_rows=60000, allowed={"line": [1, 2, 3, 4, 5]})
    return contract.check(lines(spark, sf))


@query(
    "ct07_first_failure",
    with_("lines")
    + """SELECT 'no_duplicates' AS "check", CAST(sum(n - 1) AS BIGINT) AS observed, CAST(0 AS BIGINT) AS expected
         FROM (SELECT count(*) AS n FROM lines GROUP BY line, flag)""",
)
def ct07b(spark, sf):
    checks = contracts.Contract(target="flag", n_columns=2).check(lines(spark, sf).select("line", "flag"))
    return contracts.first_failure(checks)


@query(
    "ct08_schema_manifest",
    with_("accounts")
    + """, c(position, "column", dtype) AS (VALUES (0, 'row_id', 'bigint'), (1, 'amount', 'double'), (2, 'age', 'bigint'),
           (3, 'priority', 'bigint'), (4, 'segment', 'bigint'), (5, 'month', 'bigint'), (6, 'year', 'bigint'),
           (7, 'target', 'int'))
         SELECT position, "column", dtype, (SELECT count(*) FROM accounts) AS n_rows, CAST(8 AS BIGINT) AS n_cols FROM c""",
)
def ct08(spark, sf):
    return contracts.schema_manifest(accounts(spark, sf))


@query(
    "ct09_fingerprint",
    """SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_cols, 'o_orderkey,o_custkey,o_totalprice' AS column_names,
              CAST(8 AS INTEGER) AS short_length, true AS same_after_reorder, false AS same_after_edit FROM orders""",
)
def ct09(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    plain = contracts.content_fingerprint(orders)
    moved = contracts.content_fingerprint(orders.repartition(7, "o_custkey")).select(F.col("digest").alias("d2"))
    edited = contracts.content_fingerprint(
        orders.withColumn("o_custkey", F.when(F.col("o_orderkey") == 1, -1).otherwise(F.col("o_custkey")).cast("long"))
    ).select(F.col("digest").alias("d3"))
    # Three one-row tables.
    both = plain.crossJoin(F.broadcast(moved)).crossJoin(F.broadcast(edited))
    return both.select(
        "n_rows", "n_cols", "column_names", F.length("short_digest").alias("short_length"),
        (F.col("digest") == F.col("d2")).alias("same_after_reorder"),
        (F.col("digest") == F.col("d3")).alias("same_after_edit"),
    )


def records(spark, sf):
    """Event props as records, some of them damaged by a fixed rule."""
    i = F.col("event_id") % 10
    damaged = (
        F.when(i == 0, F.lit("{}")).when(i == 1, F.regexp_replace("props", r": *(\d+)", ': "$1"'))
        .when(i == 2, F.lit("not json")).otherwise(F.col("props"))
    )
    return table(spark, sf, "events").select("event_id", damaged.alias("record_text"))


@query(
    "ct10_strict_records",
    """SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'missing: k' WHEN 1 THEN 'not an integer: k'
              WHEN 2 THEN 'not a JSON object' END AS reason,
              CASE WHEN event_id % 10 > 2 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def ct10(spark, sf):
    checked = contracts.validate_json_records(records(spark, sf), "record_text", ["k"])
    good, bad = contracts.accepted_and_quarantined(checked)
    return good.select("event_id", F.lit(None).cast("string").alias("reason"), "k").unionByName(
        bad.select("event_id", "reason", F.lit(None).cast("long").alias("k"))
    )


@query("ct11_non_empty_batch", "SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def ct11(spark, sf):
    return contracts.require_rows(
        table(spark, sf, "events").where(F.col("event_type") == "purchase").select("event_id", "value")
    )


@query(
    "ct12_required_params",
    with_(*RUN_CTES)
    + """SELECT run_id, CASE WHEN suppkey % 3 = 0 THEN 'n_val,seed' ELSE 'n_val' END AS missing FROM runs""",
)
def ct12(spark, sf):
    heads = run_heads(spark, sf)
    params = F.map_filter(
        F.create_map(F.lit("model_name"), F.col("model_name"), F.lit("seed"), F.when(F.col("suppkey") % 3 != 0, "42")),
        lambda k, v: v.isNotNull(),
    )
    return contracts.missing_param_keys(heads.select("run_id", params.alias("params")), ["model_name", "seed", "n_val"])


@query(
    "ct13_clean_build",
    with_("lines")
    + """SELECT count(*) AS n_read, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM
           (SELECT quantity, line, flag, status, discount, target FROM lines))) AS BIGINT) AS n_removed,
           (SELECT count(*) FROM (SELECT DISTINCT quantity, line, flag, status, discount, target FROM lines)) AS n_clean,
           true AS passed FROM lines""",
)
def ct13(spark, sf):
    raw_path, clean_path = fresh_path(spark, "raw"), fresh_path(spark, "clean")
    raw = lines(spark, sf).select("quantity", "line", "flag", "status", "discount", "target")
    tables.write_titled_text(raw, raw_path, title="raw lines")
    loaded = tables.read_titled_text(spark, raw_path, raw.schema)
    tables.write_parquet(contracts.drop_duplicates(loaded), clean_path)
    clean = spark.read.parquet(clean_path)
    contracts.Contract(target="target", n_columns=6, allowed={"flag": [0, 1, 2]}).enforce(clean)
    # Two one-row tables.
    sizes = loaded.agg(F.count(F.lit(1)).alias("n_read")).crossJoin(
        F.broadcast(clean.agg(F.count(F.lit(1)).alias("n_clean")))
    )
    return sizes.select(
        "n_read", (F.col("n_read") - F.col("n_clean")).alias("n_removed"), "n_clean", F.lit(True).alias("passed")
    )


@query(
    "ct13_checked_build",
    f"""WITH {FILES_SQL}
        SELECT 'as given' AS build, CAST(0 AS BIGINT) AS n_changed, (SELECT count(*) FROM orders) AS n_read,
          (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)) AS n_clean
        UNION ALL SELECT 'altered', count(*) FILTER (good <> bad), NULL, NULL FROM files""",
)
def ct13b(spark, sf):
    """A build from files whose digests were given before; it stops where one of them is wrong."""
    manifest = given_contents(spark, sf).select("file_name", F.sha2("content", 256).alias("sha256"))
    schema = T.StructType().add("key", "long").add("customer", "long").add("status", "string")
    out = None
    for build, altered in (("as given", False), ("altered", True)):
        path = order_files(spark, sf, altered)
        found = by_folder(artifacts.file_checksums(spark, path, pattern="part-*"))
        changed = artifacts.checksum_mismatches(found, manifest).count()
        n_read = n_clean = None
        if not changed:
            # Without the folders' column, which is no part of the files.
            loaded = tables.read_titled_text(spark, path, schema, sep="|", id_col="key").select(
                "customer", F.expr("instr('FOP', status)").alias("status"), (F.col("status") == "F").cast("int").alias("target")
            )
            clean_path = fresh_path(spark, "clean")
            tables.write_parquet(contracts.drop_duplicates(loaded), clean_path)
            clean = spark.read.parquet(clean_path)
            contracts.Contract(target="target", n_columns=3, allowed={"status": [1, 2, 3]}).enforce(clean)
            n_read, n_clean = loaded.count(), clean.count()
        row = spark.createDataFrame([(build, changed, n_read, n_clean)], "build string, n_changed long, n_read long, n_clean long")
        out = row if out is None else out.unionByName(row)
    return out


# --- projections and filters ------------------------------------------------------------


@query("pr01_features_target", with_("accounts") + "SELECT row_id, amount, age, priority, segment, month FROM accounts")
def pr01(spark, sf):
    features, _ = split_features_target(accounts(spark, sf), ACCOUNT_ROLES)
    return features


@query("pr02_numeric_columns", "SELECT c_custkey, c_nationkey FROM customer")
def pr02(spark, sf):
    customer = table(spark, sf, "customer")
    return customer.select(*numeric_columns(customer, exclude=["c_acctbal"]))


@query("pr04_present_columns", with_("accounts") + "SELECT amount, segment FROM accounts WHERE year >= 1998")
def pr04(spark, sf):
    base = accounts(spark, sf)
    other = base.select("row_id", "amount", "segment")
    return base.where(F.col("year") >= 1998).select(*ACCOUNT_ROLES.present_in(base, other).features)


DERIVED_SQL = (
    "SELECT cust, round(avg_bill, 4) AS avg_bill, round(avg_paid, 4) AS avg_paid, "
    "round(avg_bill / nullif(credit, 0), 4) AS utilisation, round(avg_paid / (avg_bill + 1), 6) AS paid_ratio, n_delays "
    "FROM (SELECT *, (" + " + ".join(BILLS) + ") / 6 AS avg_bill, (" + " + ".join(PAYMENTS) + ") / 6 AS avg_paid, "
    + " + ".join(f"CASE WHEN {d} > 0 THEN 1 ELSE 0 END" for d in DELAYS) + " AS n_delays FROM panel)"
)


def derived(spark, sf):
    """Row features over the wide panel."""
    out = panel(spark, sf).withColumn("avg_bill", X.row_mean(BILLS)).withColumn("avg_paid", X.row_mean(PAYMENTS))
    out = out.withColumn("utilisation", F.try_divide("avg_bill", "credit"))
    out = out.withColumn("paid_ratio", F.col("avg_paid") / (F.col("avg_bill") + 1))
    return out.withColumn("n_delays", X.row_count_where(DELAYS, lambda c: c > 0))


@query("pr05_derived_features", with_("panel") + DERIVED_SQL)
def pr05(spark, sf):
    return derived(spark, sf).select(
        "cust", F.round("avg_bill", 4).alias("avg_bill"), F.round("avg_paid", 4).alias("avg_paid"),
        F.round("utilisation", 4).alias("utilisation"), F.round("paid_ratio", 6).alias("paid_ratio"), "n_delays",
    )


@query(
    "pr06_run_filters",
    with_(*RUN_CTES)
    + """SELECT run_id, run_name FROM runs WHERE stage IN ('tune', 'dimred') AND training_time_s IS NOT NULL
         AND (run_name LIKE '%__pca_k10__%' OR model_name = 'gb')""",
)
def pr06(spark, sf):
    runs = wide_runs(spark, sf)
    return runs.where(
        F.col("stage").isin("tune", "dimred")
        & F.col("training_time_s").isNotNull()
        & (X.contains(F.col("run_name"), "__pca_k10__") | (F.col("model_name") == "gb"))
    ).select("run_id", "run_name")


# Values with a long tail, so that outliers exist.
SKEWED_SQL = """skewed AS (SELECT o_orderkey AS row_id, o_totalprice * o_totalprice * o_totalprice * o_totalprice * o_totalprice * o_totalprice / 1e34 AS power,
                 o_totalprice AS amount FROM orders)"""


def skewed(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), (price * price * price * price * price * price / 1e34).alias("power"), price.alias("amount")
    )


@query(
    "pr07_outlier_rows",
    f"""WITH {SKEWED_SQL}, q AS (SELECT quantile_cont(power, 0.25) AS q1, quantile_cont(power, 0.75) AS q3 FROM skewed),
        p AS (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM skewed)
        SELECT row_id, 'power' AS feature, round(power, 6) AS value FROM skewed, q
        WHERE power < q1 - 1.5 * (q3 - q1) OR power > q3 + 1.5 * (q3 - q1)
        UNION ALL SELECT row_id, 'amount', round(amount, 6) FROM skewed, p
        WHERE amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1)""",
)
def pr07(spark, sf):
    rows = profile.outlier_rows(skewed(spark, sf), "row_id", ["power", "amount"])
    return rows.withColumn("value", F.round("value", 6))


@query(
    "pr09_seeded_sample",
    """SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'view')
       ORDER BY md5('7:' || event_id), event_id LIMIT 25""",
)
def pr09(spark, sf):
    eligible = table(spark, sf, "events").where(F.col("event_type").isin("error", "view"))
    return splits.sample_rows(eligible, "event_id", 25, seed=7).select("event_id", "event_type")


# --- scalar expressions -----------------------------------------------------------------


@query(
    "sc01_run_name",
    with_("run_heads")
    + """SELECT run_id, stage || '__' || model_name || '__numstd_catoh__' ||
         CASE WHEN stage = 'dimred' THEN dimred_method || '_k' || dimred_n_components ELSE 'none' END || '__' ||
         search_type || '__seed42__data' || substr(run_id, 1, 8) || '__code' || substr(run_id, 9, 7) AS name
         FROM run_heads""",
)
def sc01(spark, sf):
    name = X.run_name(
        F.col("stage"), F.col("model_name"), F.lit("numstd_catoh"),
        X.reduction_label(F.col("dimred_method"), F.col("dimred_n_components")), F.col("search_type"), F.lit(42),
        X.short_digest(F.col("run_id")), F.substring("run_id", 9, 7),
    )
    return run_heads(spark, sf).select("run_id", name.alias("name"))


@query(
    "sc02_parse_run_name",
    with_("run_heads")
    + """SELECT run_id, stage, CASE WHEN suppkey % 2 = 0 THEN search_type ELSE 'none' END AS search FROM run_heads""",
)
def sc02(spark, sf):
    full = F.col("run_name")
    name = F.when(F.col("suppkey") % 2 == 0, full).otherwise(F.substring_index(full, "__", 3))
    return run_heads(spark, sf).select("run_id", X.run_stage(name).alias("stage"), X.run_search(name).alias("search"))


@query(
    "sc03_reduction_label",
    with_("run_heads")
    + """SELECT run_id, CASE WHEN dimred_method = 'none' THEN '-' ELSE dimred_method || '_k' || dimred_n_components END
         AS label FROM run_heads""",
)
def sc03(spark, sf):
    label = X.reduction_label(F.col("dimred_method"), F.col("dimred_n_components"), none="-")
    return run_heads(spark, sf).select("run_id", label.alias("label"))


@query(
    "sc04_extract_winner",
    with_("run_heads")
    + """SELECT run_id, CASE WHEN suppkey % 4 = 0 THEN '' ELSE run_id END AS found FROM run_heads""",
)
def sc04(spark, sf):
    text = F.when(F.col("suppkey") % 4 == 0, F.lit("no winner yet")).otherwise(
        F.concat(F.lit("## Winner - winner_run_id:  "), F.col("run_id"), F.lit(" (step 1)"))
    )
    return run_heads(spark, sf).select("run_id", X.winner_id(text).alias("found"))


@query(
    "sc05_typed_params",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'bool' WHEN 2 THEN 'int' WHEN 3 THEN 'float'
              ELSE 'string' END AS kind,
              CASE WHEN event_id % 5 = 1 THEN event_id % 2 = 0 END AS as_bool,
              CASE WHEN event_id % 5 = 2 THEN user_id END AS as_long,
              CASE WHEN event_id % 5 = 3 THEN user_id + 0.25 END::DOUBLE AS as_double,
              CASE WHEN event_id % 5 = 4 THEN CASE WHEN event_id % 3 = 0 THEN '1d' ELSE event_type END END AS as_string FROM events""",
)
def sc05(spark, sf):
    i = F.col("event_id") % 5
    text = (
        F.when(i == 0, F.lit("None"))
        .when(i == 1, F.when(F.col("event_id") % 2 == 0, "true").otherwise("FALSE"))
        .when(i == 2, F.col("user_id").cast("string"))
        .when(i == 3, F.concat(F.col("user_id").cast("string"), F.lit(".25")))
        .when(F.col("event_id") % 3 == 0, "1d")
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf, "events").select("event_id", X.typed_param(text).alias("p")).select("event_id", "p.*")


@query(
    "sc06_text_functions",
    """SELECT p_partkey, lower(replace(trim(p_name), ' ', '_')) AS name, starts_with(p_type, 'ECO') AS economy,
              contains(p_brand, '#1') AS brand_one, substr(md5(p_name), 1, 8) AS short FROM part""",
)
def sc06(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        X.normalise_text(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("name"),
        F.col("p_type").startswith("ECO").alias("economy"),
        X.contains(F.col("p_brand"), "#1").alias("brand_one"),
        X.short_digest(F.md5("p_name")).alias("short"),
    )


@query(
    "sc07_family_rank",
    with_("run_heads")
    + """SELECT run_id, CASE WHEN suppkey % 13 = 0 THEN 99 WHEN suppkey % 11 = 0 THEN 2 WHEN model_family = 'linear' THEN 0
         WHEN model_family = 'tree' THEN 1 ELSE 2 END AS rank FROM run_heads""",
)
def sc07(spark, sf):
    """Some runs have a family of their own, some have none."""
    key = F.col("suppkey")
    family = F.when(key % 13 == 0, "other").when(key % 11 != 0, F.col("model_family"))
    return run_heads(spark, sf).select("run_id", X.family_rank(family).alias("rank"))


@query(
    "sc08_rounding",
    """SELECT o_orderkey, round(o_totalprice / 7, 4) AS up4, round_even(o_totalprice / 7, 2) AS even2,
              round(100 * o_totalprice / nullif(o_custkey * 13.0::DOUBLE, 0), 2) AS pct, printf('%.4f', o_totalprice / 3) AS text
       FROM orders""",
)
def sc08(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(price / 7, 4).alias("up4"),
        X.half_even(price / 7, 2).alias("even2"),
        X.percent(price, F.nullif(F.col("o_custkey") * 13.0, F.lit(0.0))).alias("pct"),
        X.fixed_point(price / 3).alias("text"),
    )


@query(
    "sc09_row_mean_count",
    with_("panel")
    + "SELECT cust, round((" + " + ".join(BILLS) + ") / 6, 4) AS mean_bill, "
    + " + ".join(f"CASE WHEN {b} > 200000 THEN 1 ELSE 0 END" for b in BILLS) + " AS n_large FROM panel",
)
def sc09(spark, sf):
    return panel(spark, sf).select(
        "cust", F.round(X.row_mean(BILLS), 4).alias("mean_bill"),
        X.row_count_where(BILLS, lambda c: c > 200000).alias("n_large"),
    )


@query(
    "sc10_digests",
    """SELECT doc_id, sha256(text) AS digest, substr(sha256(text), 1, 8) AS short, md5(text) AS md5 FROM documents""",
)
def sc10(spark, sf):
    digest = F.sha2("text", 256)
    return table(spark, sf, "documents").select(
        "doc_id", digest.alias("digest"), X.short_digest(digest).alias("short"), F.md5("text").alias("md5")
    )


@query(
    "sc11_utc_text",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS at, strftime(ts, '%Y-%m-%d') AS day FROM events",
)
def sc11(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", X.utc_text(F.col("ts")).alias("at"), F.date_format("ts", "yyyy-MM-dd").alias("day")
    )


@query(
    "sc12_json_ids",
    "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'P'",
)
def sc12(spark, sf):
    """Id lists per customer as JSON text, read back and exploded.

    A list covers a range of 1000 unique keys, so no customer's list outgrows that.
    """
    pending = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    ids = pending.groupBy("o_custkey", F.floor(F.col("o_orderkey") / 1000).alias("page")).agg(
        F.collect_list("o_orderkey").alias("ids")
    )
    text = ids.select(F.to_json(F.struct("o_custkey", "page", "ids")).alias("json"))
    back = text.select(F.from_json("json", ids.schema).alias("r"))
    return back.select("r.o_custkey", F.explode("r.ids").alias("o_orderkey"))


@query(
    "sc13_metric_default",
    with_(*RUN_CTES)
    + """SELECT run_id, coalesce(roc_auc, 0.0) AS auc, coalesce(training_time_s, 'infinity'::DOUBLE) = 'infinity'::DOUBLE
         AS never_logged FROM runs""",
)
def sc13(spark, sf):
    return wide_runs(spark, sf).select(
        "run_id",
        X.metric_or(F.col("roc_auc"), 0.0).alias("auc"),
        (X.metric_or(F.col("training_time_s")) == float("inf")).alias("never_logged"),
    )
