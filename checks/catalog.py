"""Every registered query with the SQL it is compared to."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from checks.build import built, raw_files, table
from checks.versions import COMPARED, KEY, left_version, right_version, sql_versions
from revisit.functions.cleaning import count_in, tail_band
from revisit.operators import distinct, quality, quantiles, rates, reconcile, reshape
from revisit.operators.keys import group_size, keep_first, sequence, surrogate_key
from revisit.plans import cleaning, documents, kpis, ledgers, refresh, reports, star
from revisit.plans import vocabulary as V
from revisit.session import fresh_folder, write_table
from revisit.sources import readers, writers

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def on_tables(name: str, sql: str | None, run: Callable[[Tables], DataFrame]) -> None:
    """A query over the built encounter tables."""
    QUERIES[name] = Query(lambda spark, sf_dir: run(built(spark, sf_dir)), sql)


def on_folder(name: str, sql: str | None) -> Callable:
    """A query that reads the driver's tables itself."""

    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = Query(run, sql)
        return run

    return register


def typed(t: Tables) -> DataFrame:
    return cleaning.typed(t["stg_encounters"])


def keys(t: Tables) -> DataFrame:
    return cleaning.encounter_keys(typed(t))


# Sources and sinks ---------------------------------------------------------------------------

def _cells_sql(source: str, but: str = "") -> str:
    """Every filled cell as the name of its column and its text."""
    return f"(UNPIVOT (SELECT CAST(COLUMNS(*{but}) AS VARCHAR) FROM {source}) ON COLUMNS(*) INTO NAME name VALUE value)"


CELLS_SUM = "CAST(coalesce(sum(CAST('0x' || substr(md5(name || ':' || value), 1, 8) AS BIGINT)), 0) AS VARCHAR)"
ORDER_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@on_folder(
    "csv_round_trip",
    f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in ORDER_TEXT)} FROM orders",
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{fresh_folder(spark)}/orders"
    writers.export_csv(table(spark, sf_dir, "orders").select(*ORDER_TEXT), path)
    return readers.read_text_csv(spark, path, ORDER_TEXT)


on_tables("stage_encounters", O.sql("SELECT * FROM raw"), lambda t: t["stg_encounters"])
on_tables(
    "stage_ids_mapping",
    O.sql("""SELECT l.admission_type_id, l.description, CAST(count(e.encounter_id) AS BIGINT) AS raw_rows
FROM lookups l LEFT JOIN raw e ON e.admission_type_id = l.admission_type_id GROUP BY ALL"""),
    lambda t: t["stg_ids_mapping"]
    .join(t["stg_encounters"].groupBy("admission_type_id").agg(F.count(F.lit(1)).alias("n")), "admission_type_id", "left")
    .groupBy("admission_type_id", "description")
    .agg(F.max(F.coalesce("n", F.lit(0))).cast("bigint").alias("raw_rows")),
)


@on_folder(
    "stage_stacked_lookup",
    """WITH lines AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS id, r_name AS description FROM region
  UNION ALL SELECT NULL, NULL UNION ALL SELECT 'n_nationkey', 'n_name'
  UNION ALL SELECT CAST(n_nationkey AS VARCHAR), concat(' ', n_name, ', ', n_regionkey) FROM nation),
used AS (SELECT CAST(c_nationkey AS VARCHAR) AS id, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1)
SELECT lines.id, lines.description, coalesce(n, 0) AS customers FROM lines LEFT JOIN used USING (id)""",
)
def stage_stacked_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lookups stacked in one file, with the number of customers that use each id."""
    path = f"{fresh_folder(spark)}/stacked"
    regions = table(spark, sf_dir, "region").select(
        F.lit(1).alias("part"), F.col("r_regionkey").alias("id"), F.format_string("%d,%s", "r_regionkey", "r_name").alias("value")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.lit(3), "n_nationkey", F.format_string('%d," %s, %d"', "n_nationkey", "n_name", "n_regionkey")
    )
    marks = spark.createDataFrame(
        [(0, 0, "id,description"), (2, 0, ","), (2, 1, "n_nationkey,n_name")], "part int, id int, value string"
    )
    lines = marks.union(regions).union(nations)
    lines.repartition(1).sortWithinPartitions("part", "id").select("value").write.text(path)
    staged = readers.read_stacked_csv(spark, path, ["id", "description"])
    used = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("string").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return staged.join(used, "id", "left").select("id", "description", F.coalesce("n", F.lit(0)).cast("bigint").alias("customers"))


@on_folder(
    "csv_line_breaks",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, '\"' || props || chr(10) || event_type || '\"' AS note FROM events",
)
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with line breaks and doubled quotes, written and read by tasks that each take a part of a file."""
    path = f"{fresh_folder(spark)}/notes"
    note = F.concat(F.lit('"'), "props", F.lit("\n"), "event_type", F.lit('"')).alias("note")
    writers.export_csv(table(spark, sf_dir, "events").select("event_id", note), path)
    return readers.read_quoted_csv(spark, path, ["event_id", "note"])


PUBLISHED = ["region", "nation", "supplier"]


@on_folder(
    "namespace_tables",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT CAST(count(*) AS BIGINT) FROM {n}) AS n, {CELLS_SUM} AS checksum FROM {_cells_sql(n, ' EXCLUDE (s_acctbal)' if n == 'supplier' else '')}"
        for n in PUBLISHED
    ),
)
def namespace_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written, made known in a database and read by their names there."""
    root, before = fresh_folder(spark), spark.catalog.currentDatabase()
    writers.replace_tables(spark, {n: lambda n=n: table(spark, sf_dir, n) for n in PUBLISHED}, root)
    try:
        writers.publish_tables(spark, PUBLISHED, root, "published")
        found = {n: spark.table(n) for n in PUBLISHED}
    finally:
        spark.catalog.setCurrentDatabase(before)
    sums = {n: writers.checksum([c for c in df.columns if df.schema[c].dataType.typeName() != "double"]).cast("string") for n, df in found.items()}
    return quality.union_all([df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n"), sums[n].alias("checksum")) for n, df in found.items()])


@on_folder("sample_modulus", "SELECT * FROM orders WHERE o_orderkey % 691 = 7 ORDER BY o_orderkey")
def sample_modulus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.modulus_sample(table(spark, sf_dir, "orders"), "o_orderkey", 691, 7)


@on_folder("sample_raw_encounters", O.sql("SELECT * FROM raw WHERE CAST(encounter_id AS BIGINT) % 691 = 7"))
def sample_raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.modulus_sample(built(spark, sf_dir)["stg_encounters"], "encounter_id", 691, 7)


STAR_SOURCES = {
    "fact_encounter": "fact", "fact_encounter_medication": "fact_med", "dim_patient": "dim_patient", "dim_age_group": "dim_age",
    "dim_diagnosis_group": "dim_diag", "dim_admission_type": "dim_type", "dim_discharge_disposition": "dim_discharge",
    "dim_admission_source": "dim_source", "dim_medication": "dim_drug",
}


@on_folder(
    "export_star",
    O.sql(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, name AS column_name, (SELECT CAST(count(*) AS BIGINT) FROM {source}) AS rows, "
            f"CAST(count(*) AS BIGINT) AS filled_cells, {CELLS_SUM} AS checksum, true AS in_order FROM {_cells_sql(source)} GROUP BY name"
            for name, source in STAR_SOURCES.items()
        )
    ),
)
def export_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine star tables exported to CSV: order and content of every column that holds anything, from the written files."""
    tables, root = built(spark, sf_dir), fresh_folder(spark)
    writers.export_tables(tables, refresh.STAR_TABLES, root)
    found = []
    for name in refresh.STAR_TABLES:
        summary = writers.export_summary(writers.export_manifest(spark, f"{root}/{name}", tables[name].schema)).where("filled_cells > 0")
        found.append(summary.select(F.lit(name).alias("table_name"), "*").withColumn("checksum", F.col("checksum").cast("string")))
    return quality.union_all(found)


REFRESHED = [
    ("stg_encounters", "raw"), ("stg_ids_mapping", "lookups"), ("cln_encounters", "clean"),
    ("cln_encounter_medications", "meds"), ("fact_encounter", "fact"), ("fact_encounter_medication", "fact_med"),
    ("dim_patient", "dim_patient"), ("dim_age_group", "dim_age"), ("dim_diagnosis_group", "dim_diag"),
    ("dim_admission_type", "dim_type"), ("dim_discharge_disposition", "dim_discharge"),
    ("dim_admission_source", "dim_source"), ("dim_medication", "dim_drug"),
    *[(name, f"({select})") for name, select in {**O.KPIS, **O.QUALITY}.items()],
]


@on_folder(
    "refresh_all_tables",
    O.sql(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, (SELECT CAST(count(*) AS BIGINT) FROM {source} q) AS n, {CELLS_SUM} AS checksum FROM {_cells_sql(source + ' q')}"
            for name, source in REFRESHED
        )
    ),
)
def refresh_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh from the raw files, run twice into the same folder; rows of all 32 tables and a checksum of all their cells."""
    root = fresh_folder(spark)
    refresh.refresh(spark, *raw_files(spark, sf_dir), root)
    tables = refresh.refresh(spark, *raw_files(spark, sf_dir), root)
    names = writers.find_tables(tables, "stg_*", "cln_*", "fact_*", "dim_*", "a_*", "dq_*")
    sums = {n: writers.checksum(tables[n].columns, tables[n].schema).cast("string").alias("checksum") for n in names}
    return quality.union_all([tables[n].agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n"), sums[n]) for n in names])


# Cleaning ------------------------------------------------------------------------------------

on_tables("clean_typed", O.sql("SELECT * FROM typed"), typed)
on_tables("clean_dedupe", O.sql("SELECT * FROM kept"), lambda t: cleaning.deduplicated(typed(t)))
on_tables(
    "clean_keys",
    O.sql("SELECT encounter_id, patient_nbr, num_medications, num_lab_procedures FROM kept"),
    keys,
)
on_tables("clean_sequence", O.sql("SELECT * FROM numbered"), lambda t: cleaning.patient_sequence(keys(t)))
on_tables(
    "clean_sequence_split",
    O.sql("SELECT * FROM numbered"),
    lambda t: cleaning.patient_sequence(keys(t), hot_rows=3, block_bits=6),
)
on_tables(
    "clean_bounds",
    O.sql("""SELECT m1 AS num_medications_q1, m3 AS num_medications_q3, m3 + 3 * (m3 - m1) AS num_medications_fence,
l1 AS num_lab_procedures_q1, l3 AS num_lab_procedures_q3, l3 + 3 * (l3 - l1) AS num_lab_procedures_fence FROM bounds"""),
    lambda t: cleaning.fences(keys(t)),
)


def code_groups(t: Tables) -> DataFrame:
    rows = cleaning.with_code_numbers(cleaning.deduplicated(typed(t)))
    groups = [f"{cleaning.diagnosis_group(i)} AS diag_{i}_group" for i in (1, 2, 3)]
    return rows.selectExpr("encounter_id", "diag_1", "diag_2", "diag_3", *groups)


on_tables(
    "clean_code_groups",
    O.sql(f"""SELECT encounter_id, diag_1, diag_2, diag_3, {', '.join(f"coalesce(c{i}.chapter, 'Missing') AS diag_{i}_group" for i in (1, 2, 3))}
FROM kept {' '.join(f'LEFT JOIN codes c{i} ON diag_{i} = c{i}.code' for i in (1, 2, 3))}"""),
    code_groups,
)
def row_counts_of(t: Tables) -> DataFrame:
    """Drug counts over the wide columns, next to those that cleaning takes from the packed text."""
    meds = list(cleaning.MED_COLUMNS.values())
    wide = {"wide_diabetes_meds": count_in(meds, V.PRESCRIBED), "wide_meds_changed": count_in(meds, V.DOSE_CHANGED)}
    return t["cln_encounters"].selectExpr(*ROW_COLUMNS, *[f"{rule} AS {name}" for name, rule in wide.items()])


ROW_COLUMNS = ["encounter_id", "n_diabetes_meds", "n_meds_changed", "age_mid", "prior_visits_total", "los_band", "prior_inpatient_band"]
on_tables(
    "clean_row_counts",
    O.sql(f"""SELECT {', '.join(ROW_COLUMNS)}, n_diabetes_meds AS wide_diabetes_meds, n_meds_changed AS wide_meds_changed
FROM clean"""),
    row_counts_of,
)
on_tables("clean_encounters", O.sql("SELECT * FROM clean"), lambda t: t["cln_encounters"])
on_tables(
    "clean_rejected",
    O.sql("SELECT * FROM kept ANTI JOIN clean USING (encounter_id)"),
    lambda t: cleaning.rejected(typed(t)),
)
on_tables("meds_long", O.sql("SELECT * FROM meds"), lambda t: t["cln_encounter_medications"])


@on_folder(
    "quantity_fences",
    """SELECT q1 AS quantity_q1, q3 AS quantity_q3, q3 + 1.5 * (q3 - q1) AS quantity_fence, m AS quantity_median,
  (SELECT CAST(count(*) AS BIGINT) FROM lineitem WHERE l_quantity > q3) AS above_q3
FROM (SELECT quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3, quantile_cont(l_quantity, 0.5) AS m FROM lineitem)""",
)
def quantity_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("quantity"))
    fence = quantiles.upper_fences(items, ["quantity"], reach=1.5)
    median = quantiles.quantiles(items, ["quantity"], [0.5]).select("value")
    above = items.where(F.col("quantity") > fence.select("quantity_q3").scalar()).agg(F.count(F.lit(1)))
    return fence.select("*", median.scalar().alias("quantity_median"), above.scalar().alias("above_q3"))


@on_folder(
    "numeric_quantiles",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, p::DOUBLE AS p, round((SELECT quantile_cont({value}, {p}) FROM {source})::DOUBLE, 6) AS value FROM (SELECT {p} AS p)"
        for name, value, source in (
            ("price", "l_extendedprice", "lineitem"), ("loss", "-l_extendedprice * l_discount", "lineitem"), ("line", "l_orderkey * 1000000 - l_partkey", "lineitem"), ("value", "value", "events"),
        )
        for p in (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    ),
)
def numeric_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of doubles, negative ones among them, and of whole numbers of 64 bits.

    To six places, as engines differ in the last bit of what lies between two values.
    """
    wanted = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("price"), (-F.col("l_extendedprice") * F.col("l_discount")).alias("loss"), (F.col("l_orderkey") * 1000000 - F.col("l_partkey")).alias("line")
    )
    events = quantiles.quantiles(table(spark, sf_dir, "events"), ["value"], wanted)
    found = quantiles.quantiles(items, ["price", "loss", "line"], wanted).unionByName(events)
    return found.withColumn("value", F.round("value", 6))


# Star schema ---------------------------------------------------------------------------------

on_tables("dim_age_group", O.sql("SELECT * FROM dim_age"), lambda t: star.dim_age_group(t["cln_encounters"]))
on_tables("dim_diagnosis_group", O.sql("SELECT * FROM dim_diag"), lambda t: star.dim_diagnosis_group(t["cln_encounters"]))
on_tables("dim_patient", O.sql("SELECT * FROM dim_patient"), lambda t: star.dim_patient(t["cln_encounters"]))


def use_of(t: Tables, dim: str, key: str, fact: str) -> DataFrame:
    """A seeded dimension with the number of fact rows that use each key."""
    used = t[fact].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    joined = t[dim].join(used, key, "left").withColumn("used", F.coalesce("n", F.lit(0)).cast("bigint"))
    return joined.select(*t[dim].columns, "used")


for _dim, _view, _key, _fact in [
    ("dim_admission_type", "dim_type", "admission_type_id", "fact_encounter"),
    ("dim_discharge_disposition", "dim_discharge", "discharge_disposition_id", "fact_encounter"),
    ("dim_admission_source", "dim_source", "admission_source_id", "fact_encounter"),
    ("dim_medication", "dim_drug", "medication_key", "fact_encounter_medication"),
]:
    _source = "fact" if _fact == "fact_encounter" else "fact_med"
    on_tables(
        _dim,
        O.sql(f"""SELECT d.*, coalesce(n, 0) AS used FROM {_view} d
LEFT JOIN (SELECT {_key}, CAST(count(*) AS BIGINT) AS n FROM {_source} GROUP BY {_key}) u USING ({_key})"""),
        lambda t, dim=_dim, key=_key, fact=_fact: use_of(t, dim, key, fact),
    )

on_tables(
    "fact_encounter",
    O.sql("SELECT * FROM fact"),
    lambda t: star.fact_encounter(t["cln_encounters"], t["dim_age_group"], t["dim_diagnosis_group"]),
)
on_tables(
    "fact_encounter_medication",
    O.sql("SELECT * FROM fact_med"),
    lambda t: star.fact_encounter_medication(t["cln_encounters"], t["dim_medication"]),
)
on_tables(
    "fact_medication_join",
    O.sql("SELECT * FROM fact_med"),
    lambda t: star.join_medication_fact(t["cln_encounter_medications"], t["dim_medication"], t["fact_encounter"]),
)

# KPI tables ----------------------------------------------------------------------------------

for _name in kpis.TABLES:
    on_tables(_name, O.sql(O.KPIS[_name]), lambda t, name=_name: kpis.kpi_table(t, name))


def shared_scan(t: Tables) -> DataFrame:
    """All rate tables from one scan, in one long table."""
    tables = kpis.all_tables(t)
    parts = []
    for name, spec in kpis.RATE_TABLES.items():
        label = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in spec.keys])
        parts.append(tables[name].select(F.lit(name).alias("table_name"), label.alias("label"), "encounters", "readmit_30d_pct"))
    return quality.union_all(parts)


on_tables(
    "rate_tables_one_scan",
    O.sql(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS table_name, concat_ws('|', {', '.join(f'''coalesce(CAST({k} AS VARCHAR), '-')''' for k in spec.keys)}) "
            f"AS label, encounters, readmit_30d_pct FROM ({O.KPIS[name]}) q"
            for name, spec in kpis.RATE_TABLES.items()
        )
    ),
    shared_scan,
)

# The same operators on the driver's own tables -------------------------------------------------


@on_folder(
    "segment_rates",
    f"""SELECT c_mktsegment, n_name, CAST(count(*) AS BIGINT) AS orders,
{O.pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct, CAST(sum(urgent) AS BIGINT) AS urgent_orders,
{O.known_pct('urgent')} AS urgent_pct
FROM (SELECT o_custkey, if(o_orderpriority = '1-URGENT', 1, 0) AS urgent FROM orders) o
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY c_mktsegment, n_name""",
)
def segment_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("urgent")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), urgent)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    view = orders.join(customers, "c_custkey").join(nations, "n_nationkey")
    wanted = [
        rates.rows("orders"),
        rates.share_of_rows("share_pct"),
        rates.total("urgent_orders", "urgent"),
        rates.flag_percent("urgent_pct", "urgent"),
    ]
    return rates.rate_by(view, ["c_mktsegment", "n_name"], wanted)


@on_folder(
    "price_means",
    """SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS lines, round(favg(l_extendedprice / 3), 2) AS avg_third,
round(favg(l_tax * 1e-9 + l_extendedprice * 1e3), 2) AS avg_wide, round(100 * fsum(l_discount / 7) / sum(fsum(l_discount / 7)) OVER (), 2) AS discount_share_pct
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def price_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and shares of doubles of any number of places."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", (F.col("l_extendedprice") / 3).alias("third"), (F.col("l_tax") * 1e-9 + F.col("l_extendedprice") * 1e3).alias("wide"), (F.col("l_discount") / 7).alias("part")
    )
    wanted = [rates.rows("lines"), rates.average("avg_third", "third"), rates.average("avg_wide", "wide"), rates.share_of_total("discount_share_pct", "part")]
    return rates.rate_by(items, ["l_returnflag", "l_linestatus"], wanted)


@on_folder(
    "top_parts",
    f"""SELECT p_name, p_brand, CAST(count(*) AS BIGINT) AS lines, CAST(sum(returned) AS BIGINT) AS returned_lines,
{O.known_pct('returned')} AS returned_pct
FROM (SELECT l_partkey, if(l_returnflag = 'R', 1, 0) AS returned FROM lineitem) JOIN part ON p_partkey = l_partkey
GROUP BY p_name, p_brand HAVING count(*) >= 5 ORDER BY lines DESC, p_name, p_brand LIMIT 15""",
)
def top_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), returned)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    wanted = [rates.rows("lines"), rates.total("returned_lines", "returned"), rates.flag_percent("returned_pct", "returned")]
    by_part = rates.rate_by(lines.join(parts, "p_partkey"), ["p_name", "p_brand"], wanted, min_rows=5)
    return rates.top_n(by_part, [F.col("lines").desc(), F.col("p_name"), F.col("p_brand")], 15)


@on_folder(
    "customer_utilisation",
    f"""SELECT if(n < 5, CAST(n AS VARCHAR), '5+') AS orders_per_customer, CAST(count(*) AS BIGINT) AS customers,
CAST(sum(n) AS BIGINT) AS orders, {O.pct('sum(n)', '(SELECT count(*) FROM orders)')} AS order_share_pct
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY 1""",
)
def customer_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    banded = per_customer.withColumn("orders_per_customer", F.expr(tail_band("n", 5)))
    wanted = [rates.rows("customers"), rates.total("orders", "n"), rates.share_of_total("order_share_pct", "n")]
    return rates.rate_by(banded, ["orders_per_customer"], wanted)


@on_folder(
    "order_group_sizes",
    """SELECT o_orderkey, o_custkey, CAST(count(*) OVER (PARTITION BY o_custkey) AS BIGINT) AS customer_orders,
CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS customer_order_seq FROM orders""",
)
def order_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group size on each row, and the position of each order among its customer's orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    numbered = sequence(orders, "o_custkey", "o_orderkey", "customer_order_seq", hot_rows=12, block_bits=8)
    return group_size(numbered, "o_custkey", "customer_orders")


@on_folder(
    "order_null_customers",
    """SELECT *, CAST(count(*) OVER (PARTITION BY c) AS BIGINT) AS customer_orders, CAST(row_number() OVER (PARTITION BY c ORDER BY o_orderkey) AS BIGINT) AS customer_order_seq
FROM (SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 3 THEN o_custkey END AS c FROM orders)""",
)
def order_null_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group sizes and positions where a tenth of all rows have no entity; these are one, hot, group and are numbered in blocks."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_custkey % 10 <> 3 THEN o_custkey END AS c")
    return group_size(sequence(orders, "c", "o_orderkey", "customer_order_seq", hot_rows=40, block_bits=8), "c", "customer_orders")


@on_folder(
    "first_of_tied_copies",
    """SELECT k, o_orderpriority, o_orderstatus, o_orderkey FROM (SELECT nullif(o_custkey % 300, 7) AS k, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority, o_orderstatus, o_orderkey FROM orders)
WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY o_orderpriority NULLS LAST, o_orderstatus, o_orderkey) = 1""",
)
def first_of_tied_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a key that tie in what is preferred and differ in the rest; rows without a key go."""
    key, known = F.expr("nullif(o_custkey % 300, 7)").alias("k"), F.expr("nullif(o_orderpriority, '1-URGENT')").alias("o_orderpriority")
    orders = table(spark, sf_dir, "orders").select(key, known, "o_orderstatus", "o_orderkey")
    return keep_first(orders, "k", [F.col("o_orderpriority").asc_nulls_last(), F.col("o_orderstatus").asc()], F.col("o_orderkey"))


@on_folder(
    "surrogate_keys_many",
    """SELECT CAST(row_number() OVER (ORDER BY l_linenumber, l_orderkey, copy) AS BIGINT) AS line_key, l_orderkey, l_linenumber, copy
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), (VALUES ('a'), ('b')) c (copy)""",
)
def surrogate_keys_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys over two labels per line: more than a hundred thousand, numbered by ranges."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    labels = lines.select("*", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("copy"))
    return surrogate_key(labels, "line_key", ["l_linenumber"], "bigint")


@on_folder(
    "line_flags_long",
    """SELECT flag, code, CAST(count(*) AS BIGINT) AS lines FROM
(SELECT 'returned' AS flag, l_returnflag AS code FROM lineitem UNION ALL SELECT 'status', l_linestatus FROM lineitem)
WHERE code IN ('A', 'R', 'F') GROUP BY flag, code""",
)
def line_flags_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"l_returnflag": "returned", "l_linestatus": "status"}
    long = reshape.to_long(table(spark, sf_dir, "lineitem"), ["l_orderkey"], columns, "flag", "code", ["A", "R", "F"])
    return long.groupBy("flag", "code").agg(F.count(F.lit(1)).alias("lines"))


@on_folder(
    "event_rates",
    f"""SELECT event_type, CAST(count(*) AS BIGINT) AS events, {O.pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct,
{O.avg2('cents')} AS avg_cents FROM (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events) GROUP BY event_type""",
)
def event_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    wanted = [rates.rows("events"), rates.share_of_rows("share_pct"), rates.average("avg_cents", "cents")]
    return rates.rate_by(events, ["event_type"], wanted)


# Report measures -------------------------------------------------------------------------------


def measure_columns() -> str:
    def ratio(a: str, b: str) -> str:
        return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"

    n = lambda c: f"count(*) FILTER (WHERE {c})"
    e = "is_readmit_eligible = 1"
    rate = ratio(n(f"{e} AND readmit_30d_flag = 1"), n(e))
    columns = {
        "encounters": "CAST(count(*) AS BIGINT)",
        "patients": "CAST(count(DISTINCT patient_nbr) AS BIGINT)",
        "eligible_encounters": f"CAST({n(e)} AS BIGINT)",
        "readmits_30d": f"CAST({n(f'{e} AND readmit_30d_flag = 1')} AS BIGINT)",
        "readmits_any": f"CAST({n(f'{e} AND readmit_any_flag = 1')} AS BIGINT)",
        "readmit_30d_rate": rate,
        "readmit_any_rate": ratio(n(f"{e} AND readmit_any_flag = 1"), n(e)),
        "readmit_30d_rate_first": ratio(
            n(f"{e} AND is_first_encounter = 1 AND readmit_30d_flag = 1"), n(f"{e} AND is_first_encounter = 1")
        ),
        "avg_los_days": ratio("sum(time_in_hospital)", "count(time_in_hospital)"),
        "avg_medications": ratio("sum(num_medications)", "count(num_medications)"),
        "avg_lab_procedures": ratio("sum(num_lab_procedures)", "count(num_lab_procedures)"),
        "med_change_rate": ratio(n("med_change_flag = 1"), "count(*)"),
        "on_insulin_rate": ratio(n("insulin_flag = 1"), "count(*)"),
        "a1c_tested_rate": ratio(n("a1c_result <> 'Not measured'"), "count(*)"),
        "prior_inpatient_rate": ratio(n("number_inpatient > 0"), "count(*)"),
        "readmit_30d_vs_overall": f"{rate} - (SELECT {rate} FROM fact)",
    }
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


LABELLED = "fact JOIN dim_age USING (age_key) JOIN dim_diag ON diag_group_key = primary_diag_group_key JOIN dim_patient p USING (patient_nbr)"
MEASURES = measure_columns()
on_tables("measures_overall", O.sql(f"SELECT {MEASURES} FROM fact"), lambda t: reports.measures(t))
on_tables(
    "measures_by_age", O.sql(f"SELECT age_group, {MEASURES} FROM {LABELLED} GROUP BY age_group"), lambda t: reports.measures(t, ["age_group"])
)
on_tables(
    "measures_by_slicer",
    O.sql(f"""SELECT los_band, gender, race, {MEASURES} FROM {LABELLED}
WHERE age_mid >= 40 AND p.gender = 'Female' GROUP BY los_band, gender, race"""),
    lambda t: reports.measures(
        t, ["los_band"], ["gender", "race"], where=F.col("age_mid") >= 40, patient_where=F.col("gender") == "Female"
    ),
)
on_tables(
    "measures_primary_diagnosis",
    O.sql(f"SELECT diag_group, {MEASURES} FROM {LABELLED} GROUP BY diag_group"),
    lambda t: reports.measures(t, ["diag_group"]),
)
on_tables(
    "measures_secondary_diagnosis",
    O.sql(f"""SELECT diag_group, {MEASURES} FROM fact JOIN dim_diag ON diag_group_key = secondary_diag_group_key GROUP BY diag_group"""),
    lambda t: reports.measures(t, ["diag_group"], diagnosis_key="secondary_diag_group_key"),
)
SLICERS, PATIENT_SLICERS = ["age_group", "age_mid", "los_band", "insulin_status"], ["gender", "race"]
MIXES = {
    "overall": ([], None),
    "age": (["age_group"], None),
    "band": (["los_band", "insulin_status"], "age_mid >= 40"),
    "patient": (["gender", "los_band"], "race = 'Caucasian'"),
}
PARTS_FROM = "(SELECT * FROM fact JOIN dim_age USING (age_key) JOIN (SELECT patient_nbr, gender, race FROM dim_patient) p USING (patient_nbr)) m"


def _label(names: list[str]) -> str:
    return " || '|' || ".join(["''", *[f"coalesce({name}, '-')" for name in names]])


@on_folder(
    "measures_of_stored_parts",
    O.sql(
        " UNION ALL ".join(
            f"SELECT '{mix}' AS mix, {_label(names)} AS label, {MEASURES} FROM {PARTS_FROM} WHERE {where or 'true'} GROUP BY {', '.join(['mix', *names])}"
            for mix, (names, where) in MIXES.items()
        )
    ),
)
def measures_of_stored_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures under several mixes of slicers, on encounters and on patients, from parts that are written once."""
    parts = write_table(reports.measure_parts(built(spark, sf_dir), SLICERS, PATIENT_SLICERS), f"{fresh_folder(spark)}/parts")
    found = [(mix, names, reports.measures_of_parts(parts, names, where)) for mix, (names, where) in MIXES.items()]
    return quality.union_all([df.select(F.lit(mix).alias("mix"), F.expr(_label(names)).alias("label"), *df.columns[len(names) :]) for mix, names, df in found])


@on_folder(
    "event_users",
    """WITH e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events), middle AS (SELECT min(day) + CAST((max(day) - min(day)) // 2 AS INTEGER) AS mid FROM e),
f AS (SELECT e.*, IF(day < mid, 'early', 'late') AS half FROM e, middle)
SELECT event_type AS name, CAST(count(DISTINCT user_id) AS BIGINT) AS users, CAST(count(*) AS BIGINT) AS events FROM f GROUP BY event_type
UNION ALL SELECT half, CAST(count(DISTINCT user_id) AS BIGINT), CAST(count(*) AS BIGINT) FROM f GROUP BY half
UNION ALL SELECT 'both halves', CAST(count(*) AS BIGINT), NULL FROM (SELECT user_id FROM f GROUP BY user_id HAVING count(DISTINCT half) = 2 AND user_id IS NOT NULL)""",
)
def event_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by type and by half of the time, and users of both halves, from one set of stored parts by type and day."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("day"), F.lit(1).alias("one"))
    parts = write_table(distinct.entity_parts(events, ["event_type", "day"], "user_id", {"events": F.col("one")}), f"{fresh_folder(spark)}/parts")
    ends = parts.agg(F.expr("date_add(min(day), CAST(datediff(max(day), min(day)) div 2 AS INT))")).scalar()
    halves = parts.withColumn("half", F.when(F.col("day") < ends, "early").otherwise("late"))
    by = [distinct.pooled(halves, [key], "users", ["events"]).withColumnRenamed(key, "name") for key in ("event_type", "half")]
    both = distinct.in_all(halves, {"early": "half = 'early'", "late": "half = 'late'"}, "users")
    return quality.union_all([*by, both.select(F.lit("both halves").alias("name"), "users", F.lit(None).cast("bigint").alias("events"))])


DRUGS_SQL = """SELECT medication, CAST(count(*) AS BIGINT) AS drug_encounters,
CAST(sum(readmit_30d_flag) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS drug_readmit_30d_rate
FROM fact_med JOIN dim_drug USING (medication_key) WHERE is_readmit_eligible = 1"""
on_tables("drug_measures", O.sql(f"{DRUGS_SQL} GROUP BY medication"), lambda t: reports.drug_measures(t))
on_tables(
    "drug_measures_under_filter",
    O.sql(f"{DRUGS_SQL} AND encounter_id IN (SELECT encounter_id FROM fact WHERE time_in_hospital >= 8) GROUP BY medication"),
    lambda t: reports.drug_measures(t, F.col("time_in_hospital") >= 8),
)
on_tables(
    "drug_bar",
    O.sql(f"{DRUGS_SQL} GROUP BY medication HAVING count(*) >= 500"),
    lambda t: reports.drug_measures(t, min_rows=V.MEDICATION_MIN_ROWS),
)
on_tables(
    "overview_cards",
    O.sql(f"""SELECT encounters, patients, readmit_30d_rate, readmit_any_rate, avg_los_days, on_insulin_rate
FROM (SELECT {MEASURES} FROM fact JOIN dim_patient p USING (patient_nbr) JOIN dim_age USING (age_key)
WHERE p.gender = 'Male' AND p.race = 'Caucasian' AND age_group = '60-70') m"""),
    lambda t: reports.overview_cards(
        t, F.col("age_group") == "60-70", (F.col("gender") == "Male") & (F.col("race") == "Caucasian")
    ),
)
on_tables(
    "encounters_on_insulin",
    O.sql("SELECT * FROM fact WHERE insulin_status IN ('Steady', 'Up', 'Down')"),
    lambda t: reports.encounters_on_drug(t, "insulin"),
)
STAY_SQL = """SELECT admission_type, los_band, CAST(count(*) AS BIGINT) AS encounters,
CAST(sum(readmit_30d_flag) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate
FROM elig JOIN dim_type USING (admission_type_id) GROUP BY admission_type, los_band"""
on_tables(
    "admission_by_stay",
    O.sql(f"""SELECT *, rate - (SELECT CAST(sum(readmit_30d_flag) AS DOUBLE) / CAST(count(*) AS DOUBLE) FROM elig) AS vs_overall
FROM ({STAY_SQL}) g"""),
    reports.admission_by_stay,
)
on_tables(
    "admission_by_stay_matrix",
    O.sql(f"""SELECT admission_type, {', '.join(f'''max(rate) FILTER (WHERE los_band = '{b}') AS "{b}"''' for b in V.LOS_LABELS)}
FROM ({STAY_SQL}) g GROUP BY admission_type"""),
    reports.admission_by_stay_matrix,
)
on_tables(
    "a1c_by_change",
    O.sql(f"SELECT a1c_result, med_change_flag, {O.COUNT}, {O.RATE_30D} FROM elig GROUP BY a1c_result, med_change_flag"),
    reports.a1c_by_change,
)

# Report datasets and chart rows ----------------------------------------------------------------

on_tables(
    "report_headline",
    O.sql(f"""SELECT encounters_total, patients_total, readmit_30d_pct / 100 AS readmit_30d_rate,
readmit_any_pct / 100 AS readmit_any_rate, avg_los_days FROM ({O.KPIS['a_kpi_headline']}) k"""),
    lambda t: reports.headline_dataset(kpis.kpi_table(t, "a_kpi_headline")),
)
for _name, (_kpi, _columns, _order) in reports.DATASETS.items():
    on_tables(
        f"report_{_name}",
        O.sql(f"SELECT {', '.join(_columns)} FROM ({O.KPIS[_kpi]}) k"),
        lambda t, name=_name, kpi=_kpi: reports.dataset(kpis.kpi_table(t, kpi), name),
    )
on_tables(
    "report_cards",
    O.sql(f"""SELECT CAST(position AS INTEGER) AS position, card, value FROM ({' UNION ALL '.join(
        f"SELECT {i} AS position, '{c}' AS card, CAST({c} AS DOUBLE) AS value FROM ({O.KPIS['a_kpi_headline']}) k"
        for i, c in enumerate(reports.CARDS, start=1))}) u"""),
    lambda t: reports.cards(kpis.kpi_table(t, "a_kpi_headline")),
)
on_tables(
    "chart_diagnosis",
    O.sql(f"""SELECT primary_diagnosis_group, encounters, readmit_30d_pct FROM ({O.KPIS['a_readmit_by_diagnosis']}) k
WHERE primary_diagnosis_group <> 'Missing'"""),
    lambda t: reports.diagnosis_chart(kpis.kpi_table(t, "a_readmit_by_diagnosis")),
)
on_tables(
    "chart_insulin",
    O.sql(f"""SELECT insulin_status, encounters, readmit_30d_pct,
CAST(CASE insulin_status WHEN 'No' THEN 1 WHEN 'Steady' THEN 2 WHEN 'Up' THEN 3 WHEN 'Down' THEN 4 END AS INTEGER) AS position
FROM ({O.KPIS['a_readmit_by_insulin']}) k WHERE insulin_status IS NOT NULL"""),
    lambda t: reports.insulin_chart(kpis.kpi_table(t, "a_readmit_by_insulin")),
)

# Data quality ----------------------------------------------------------------------------------

for _name, _run in [
    ("dq_row_counts", ledgers.row_counts),
    ("dq_null_rates", ledgers.null_rates),
    ("dq_issues", ledgers.issues),
    ("dq_assertions", ledgers.assertions),
]:
    on_tables(_name, O.sql(O.QUALITY[_name]), _run)
on_tables(
    "dq_summary",
    O.sql(f"""SELECT CAST(count(*) FILTER (WHERE status = 'PASS') AS BIGINT) AS passed, CAST(count(*) AS BIGINT) AS total
FROM ({O.ASSERTIONS}) a"""),
    lambda t: quality.pass_summary(ledgers.assertions(t)),
)


@on_folder(
    "orphan_orders",
    """SELECT CAST(count(*) AS BIGINT) AS failed_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')""",
)
def orphan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is missing from a dimension that lacks one market segment."""
    customers = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'")
    return quality.orphan_rows(table(spark, sf_dir, "orders"), "o_custkey", customers, "c_custkey")


# Reconciliation --------------------------------------------------------------------------------


def versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    left = left_version(t["fact_encounter"])
    return left, right_version(left)


COUNTED = [(n, s) for n, s in REFRESHED if n in refresh.COUNTED_TABLES]


def planted_counts(t: Tables) -> DataFrame:
    left = {n: t[n] for n in refresh.COUNTED_TABLES}
    right = left | {"fact_encounter": versions(t)[1]}
    return reconcile.reconcile_counts(left, right)


COUNTS_SQL = "SELECT table_name, left_rows, right_rows, left_rows = right_rows AS is_match FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, CAST((SELECT count(*) FROM {s}) AS BIGINT) AS left_rows, "
    f"CAST((SELECT count(*) FROM {'r' if n == 'fact_encounter' else s}) AS BIGINT) AS right_rows"
    for n, s in COUNTED
) + ") c"
on_tables("reconcile_counts", O.sql(COUNTS_SQL, **sql_versions()), planted_counts)
on_tables(
    "reconcile_counts_match",
    O.sql(f"SELECT bool_and(is_match) AS all_match FROM ({COUNTS_SQL}) m", **sql_versions()),
    lambda t: reconcile.all_counts_match(planted_counts(t)),
)


def _differences_sql() -> str:
    cells = []
    for c in [c for c in COMPARED if c not in KEY]:
        number = c != "payer_code"
        near = f"abs(l.{c} - r.{c}) <= 1e-6 * greatest(1, abs(r.{c}))" if number else "false"
        cells.append(
            f"SELECT encounter_id, '{c}' AS column_name, CAST(l.{c} AS VARCHAR) AS left_value, CAST(r.{c} AS VARCHAR) AS right_value, "
            f"'value' AS problem FROM l JOIN r USING (encounter_id) "
            f"WHERE l.{c} IS DISTINCT FROM r.{c} AND NOT coalesce({near}, false)"
        )
    lost = "SELECT encounter_id, NULL, NULL, NULL, '{}' FROM {} ANTI JOIN {} USING (encounter_id)"
    return " UNION ALL ".join([*cells, lost.format("missing_right", "l", "r"), lost.format("missing_left", "r", "l")])


on_tables(
    "reconcile_differences",
    O.sql(_differences_sql(), **sql_versions()),
    lambda t: reconcile.cell_differences(*versions(t), KEY),
)
on_tables(
    "reconcile_first_differences",
    O.sql(
        f"SELECT * FROM ({_differences_sql()}) d ORDER BY encounter_id, column_name NULLS FIRST, problem LIMIT 50", **sql_versions()
    ),
    lambda t: reconcile.first_differences(reconcile.cell_differences(*versions(t), KEY), KEY),
)


PLANTED = {"d": 97, "t": 101, "urgent": 103, "tags": 107, "code": 109}


@on_folder(
    "compare_typed_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'value' AS problem, CAST(count(*) AS BIGINT) AS cells FROM orders WHERE o_orderkey % {n} = 0 HAVING count(*) > 0" for c, n in PLANTED.items()
    ),
)
def compare_typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, timestamps, booleans, arrays and text that a cast would take for a number, with planted differences."""
    day, time = F.col("o_orderdate").cast("date"), F.col("o_orderdate")
    urgent, custkey = F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")
    sides = {
        "left": [day, time, urgent, F.array(custkey % 7, F.lit(1)), F.lit("1")],
        "right": [F.date_add(day, 1), time + F.expr("INTERVAL 1 HOUR"), ~urgent, F.array(custkey % 7, F.lit(2)), F.lit("1d")],
    }
    orders = table(spark, sf_dir, "orders")
    left = orders.select("o_orderkey", *[value.alias(c) for c, value in zip(PLANTED, sides["left"])])
    hit = {c: F.col("o_orderkey") % n == 0 for c, n in PLANTED.items()}
    right = orders.select("o_orderkey", *[F.when(hit[c], y).otherwise(x).alias(c) for c, x, y in zip(PLANTED, sides["left"], sides["right"])])
    found = reconcile.cell_differences(left, right, ["o_orderkey"])
    return found.groupBy("column_name", "problem").agg(F.count(F.lit(1)).alias("cells"))


@on_folder(
    "compare_without_key",
    """SELECT l_returnflag, l_linestatus, l_quantity, l_discount, CAST(greatest(sum(s), 0) AS BIGINT) AS left_copies, CAST(greatest(-sum(s), 0) AS BIGINT) AS right_copies
FROM (SELECT *, 1 AS s FROM lineitem UNION ALL SELECT *, -1 FROM lineitem WHERE l_orderkey % 50 <> 0 UNION ALL SELECT *, -1 FROM lineitem WHERE l_orderkey % 70 = 0)
GROUP BY l_returnflag, l_linestatus, l_quantity, l_discount HAVING sum(s) <> 0""",
)
def compare_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table of repeated rows: some are missing, some are there twice, all have moved."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    right = items.where("l_orderkey % 50 <> 0").unionByName(items.where("l_orderkey % 70 = 0")).repartition("l_discount")
    return reconcile.row_surplus(items.drop("l_orderkey"), right.drop("l_orderkey"))


def kpi_reconcile(t: Tables) -> DataFrame:
    """The compared KPI and quality tables, built from the shared scan and from single scans."""
    single = {n: kpis.kpi_table(t, n) if n in kpis.TABLES else None for n in refresh.COMPARED_TABLES}
    checks = {"dq_issues": ledgers.issues(t), "dq_assertions": ledgers.assertions(t)}
    left = {n: df if df is not None else checks[n] for n, df in single.items()}
    return reconcile.reconcile_cells(left, kpis.all_tables(t) | checks, refresh.COMPARED_TABLES)


on_tables(
    "reconcile_kpi_tables",
    O.sql(
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS left_rows, CAST(count(*) AS BIGINT) AS right_rows, "
            "CAST(0 AS BIGINT) AS cell_diffs, CAST(0 AS BIGINT) AS missing_left, CAST(0 AS BIGINT) AS missing_right, "
            f"CAST(0 AS BIGINT) AS repeated_key FROM ({ {**O.KPIS, **O.QUALITY}[n] }) q"
            for n in refresh.COMPARED_TABLES
        )
    ),
    kpi_reconcile,
)

# Documents -------------------------------------------------------------------------------------


def with_results(t: Tables) -> Tables:
    out = t | {n: kpis.kpi_table(t, n) for n in ("a_kpi_headline", "a_readmit_by_age", "a_readmit_by_los_band")}
    out |= {n: kpis.kpi_table(t, n) for n in ("a_readmit_by_prior_inpatient", "a_readmit_by_diagnosis", "a_readmit_by_medication")}
    out |= {"dq_row_counts": ledgers.row_counts(t), "dq_null_rates": ledgers.null_rates(t)}
    return out | {"dq_issues": ledgers.issues(t), "dq_assertions": ledgers.assertions(t)}


def _metrics_sql() -> str:
    q = O.QUALITY
    return f"""SELECT CAST(to_json({{'kpis': k, 'data_quality': {{
  'row_counts': (SELECT list(r ORDER BY entity) FROM ({q['dq_row_counts']}) r),
  'null_rates': (SELECT list(r ORDER BY column_name) FROM ({q['dq_null_rates']}) r),
  'issues': (SELECT map(list(check_name ORDER BY check_name), list(affected_rows ORDER BY check_name)) FROM ({q['dq_issues']}) r),
  'assertions': (SELECT map(list(check_name ORDER BY check_name), list(status ORDER BY check_name)) FROM ({q['dq_assertions']}) r)}}}}) AS VARCHAR) AS document
FROM ({O.KPIS['a_kpi_headline']}) k"""


def _snapshot_sql() -> str:
    k = O.KPIS
    rates_of = lambda table, label, order: (
        f"(SELECT map(list({label} ORDER BY {order}), list(readmit_30d_pct ORDER BY {order})) FROM ({k[table]}) r)"
    )
    rules = ", ".join(f"'{name}': {O.quoted([text])}" for name, text in documents.RULES.items())
    headline = ", ".join(f"'{c}': h.{c}" for c in documents.HEADLINE)
    records = lambda columns: "{" + ", ".join(f"'{c}': {c}" for c in columns) + "}"
    group = records(["primary_diagnosis_group", "encounters", "readmit_30d_pct"])
    drug = records(["medication", "encounters_prescribed", "readmit_30d_pct"])
    return f"""SELECT CAST(to_json({{'config': {{{rules}}}, 'headline': {{{headline}}},
'readmit_30d_pct_by_age': {rates_of('a_readmit_by_age', 'age_group', 'age_mid')},
'readmit_30d_pct_by_los_band': {rates_of('a_readmit_by_los_band', 'los_band', 'los_band')},
'readmit_30d_pct_by_prior_inpatient': {rates_of('a_readmit_by_prior_inpatient', 'prior_inpatient_band', 'prior_inpatient_band')},
'top_diagnosis_groups': (SELECT list({group} ORDER BY encounters DESC, primary_diagnosis_group)[1:5] FROM ({k['a_readmit_by_diagnosis']}) r),
'medications_by_readmit_30d_pct': (SELECT coalesce(list({drug} ORDER BY readmit_30d_pct DESC, medication), []) FROM ({k['a_readmit_by_medication']}) r),
'assertions_passed': (SELECT count(*) FILTER (WHERE status = 'PASS') FROM ({O.ASSERTIONS}) a),
'assertions_total': (SELECT count(*) FROM ({O.ASSERTIONS}) a)}}) AS VARCHAR) AS document
FROM ({k['a_kpi_headline']}) h"""


on_tables("metrics_document", O.sql(_metrics_sql()), lambda t: documents.metrics(with_results(t)))
on_tables("headline_snapshot", O.sql(_snapshot_sql()), lambda t: documents.snapshot(with_results(t)))
