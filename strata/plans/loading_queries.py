"""Registered loading / data-management queries over the driver tables.

Change set used by the version, upsert and snapshot queries (derived from
``customer``; SURVEY 7): the run at T0 loads the table as it is; at T1 the
source has ``c_acctbal + 1`` for keys % 10 = 0, new keys (key + the table's largest
key + 1) for keys % 50 = 0, and for snapshots old keys % 97 = 0 deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as dt
from ..functions import protect as pr
from ..functions import text as tx
from ..operators import clean as cl
from ..operators import lake
from ..operators import loading as ld
from ..operators import versioning as vs
from ..operators.joins import null_aware_anti, top_keys_by_count
from ..session import AS_OF, scratch_path
from ..sources.tables import Tables, for_each_table
from .model import Model

T0 = "2024-06-01 00:00:00"
T1 = AS_OF
KEY = "c_custkey"
HASH_COLS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
TRACK_DAY = "2024-01-15"
# Demo key material for the column-encryption queries (32 bytes, AES-256).
DEMO_KEY = b"strata-demo-key-0123456789abcdef"


def source_v0(spark: SparkSession, d: str) -> DataFrame:
    return Tables(spark, d).customer


def source_v1(spark: SparkSession, d: str, with_deletes: bool = False) -> DataFrame:
    c = Tables(spark, d).customer
    k, last = F.col(KEY), c.agg(F.max(KEY)).scalar()
    changed = c.withColumn("c_acctbal", F.when(k % 10 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    added = c.filter(k % 50 == 0).withColumn(KEY, k + last + 1)
    out = changed.unionByName(added)
    if with_deletes:
        out = out.filter(~((k % 97 == 0) & (k <= last)))
    return out


def ver1_initial_load(spark: SparkSession, d: str) -> DataFrame:
    return vs.initial_load(source_v0(spark, d), T0)


def ver2_new_keys(spark: SparkSession, d: str) -> DataFrame:
    target = vs.initial_load(source_v0(spark, d), T0)
    return vs.open_rows(vs.new_keys(target, source_v1(spark, d), KEY), T1)


def ver2_new_keys_by_max(spark: SparkSession, d: str) -> DataFrame:
    target = vs.initial_load(source_v0(spark, d), T0)
    return vs.open_rows(vs.new_keys_by_max(target, source_v1(spark, d), KEY), T1)


def ver3_compare(spark: SparkSession, d: str) -> DataFrame:
    target = vs.initial_load(source_v0(spark, d), T0)
    return vs.scd2_compare(target, source_v1(spark, d), KEY, T1)


def _stamped_v1(spark: SparkSession, d: str) -> DataFrame:
    old = source_v0(spark, d).withColumn("last_updated", F.lit(T0).cast("timestamp_ntz"))
    return vs.stamp_changes(old, source_v1(spark, d), KEY, "last_updated", T1)


def stm1_stamp(spark: SparkSession, d: str) -> DataFrame:
    return _stamped_v1(spark, d)


def ver4_since(spark: SparkSession, d: str) -> DataFrame:
    target = vs.initial_load(source_v0(spark, d), T0)
    state = spark.range(1).select(F.lit("dest_customer").alias("table"), F.lit(T0).cast("timestamp_ntz").alias("watermark"))
    wm = vs.read_watermark(state, "dest_customer")
    return vs.scd2_since(target, _stamped_v1(spark, d), KEY, "last_updated", wm, T1)


def ver5_hash(spark: SparkSession, d: str) -> DataFrame:
    target = vs.initial_load(source_v0(spark, d), T0, hash_cols=HASH_COLS)
    return vs.scd2_hash(target, source_v1(spark, d), KEY, HASH_COLS, T1)


def ver6_change_report(spark: SparkSession, d: str) -> DataFrame:
    target = vs.initial_load(source_v0(spark, d), T0, hash_cols=HASH_COLS)
    return vs.change_report(target, source_v1(spark, d), KEY, HASH_COLS)


def wmk1_advance(spark: SparkSession, d: str) -> DataFrame:
    """Per-table watermark state built from the insert log, then one table advanced."""
    ev = Tables(spark, d).events
    state = ev.groupBy(F.col("event_type").alias("table")).agg(F.max("ts").alias("watermark"))
    return vs.advance_watermark(state, "click", T1)


def load2_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Rows to append: keys above the max already loaded (the target holds the lower half of the keys)."""
    fact = Model(spark, d).facturation
    half = fact.agg(F.expr("max(nid) div 2").alias("_half"))
    loaded = fact.crossJoin(F.broadcast(half)).filter(F.col("nid") <= F.col("_half")).drop("_half")
    return vs.incremental_append(loaded, Model(spark, d).facturation, "nid")


def load4_consolidate(spark: SparkSession, d: str) -> DataFrame:
    """Six retail tables cleaned into staging: every cleaned row, under columns that all of them share."""
    m = Model(spark, d)
    frames = {"trx": m.trx, "facturation": m.facturation, "shop": m.shop, "city": m.city, "product": m.product, "recharge": m.recharge}

    def stage(name: str) -> DataFrame:
        cleaned = cl.clean(frames[name], name)
        held = {c.lower(): c for c in cleaned.columns}

        def shared(out: str, kind: str, *names: str) -> F.Column:
            found = next((held[n] for n in names if n in held), None)
            return (F.lit(None) if found is None else F.col(found)).cast(kind).alias(out)

        return cleaned.select(
            F.lit(f"stge_{name}").alias("table_name"),  # fixed value: the prefix of staging tables
            "nid",
            shared("sname", "string", "sname"),
            shared("parent", "bigint", "nshopid", "ncityid"),
            shared("amount", "double", "namount"),
            shared("fee", "double", "noperationfee"),
            shared("day", "date", "dinsertion", "drecharge"),
        )

    staged = for_each_table(frames, stage)
    parts = list(staged.values())
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _clean_query(entity: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return cl.clean(getattr(Model(spark, d), entity), entity)

    run.__name__ = f"load3_clean_{entity}"
    return run


def _product_target(spark: SparkSession, d: str) -> DataFrame:
    p = Model(spark, d).product
    return p.filter(F.col("nid") % 3 != 0).select(
        "nid", "sname", F.lit(T0).cast("timestamp_ntz").alias("last_modified"),
        F.lit(T0).cast("timestamp_ntz").alias("dw_insert_date"), F.lit(T0).cast("timestamp_ntz").alias("dw_update_date"),
    )


def _product_changes(spark: SparkSession, d: str) -> DataFrame:
    p = Model(spark, d).product
    changed = p.filter(F.col("nid") % 4 == 0)
    added = p.filter(F.col("nid") % 25 == 0).withColumn("nid", F.col("nid") + p.agg(F.max("nid")).scalar() + 1)
    rows = changed.unionByName(added)
    return rows.select("nid", tx.capitalize("sname").alias("sname"), F.lit(T1).cast("timestamp_ntz").alias("last_modified"))


def ups1_upsert(spark: SparkSession, d: str) -> DataFrame:
    return ld.upsert(_product_target(spark, d), _product_changes(spark, d), "nid", ["sname", "last_modified"], T1)


def jn12_lookup_route(spark: SparkSession, d: str) -> DataFrame:
    return ld.route_counts(_product_changes(spark, d), _product_target(spark, d), "nid")


def snap2_differential(spark: SparkSession, d: str) -> DataFrame:
    return ld.differential(source_v0(spark, d), source_v1(spark, d, with_deletes=True), KEY)


def snap3_restore(spark: SparkSession, d: str) -> DataFrame:
    full = source_v0(spark, d)
    diff = ld.differential(full, source_v1(spark, d, with_deletes=True), KEY)
    return ld.restore(source_v0(spark, d), diff, KEY)


def trk1_first_insert(spark: SparkSession, d: str) -> DataFrame:
    return ld.first_insert_on(Tables(spark, d).events, "event_type", "ts", TRACK_DAY)


# The tables expected to receive rows every day (the log's types + one never seen).
EXPECTED_TABLES = ["click", "error", "purchase", "signup", "view", "ATM-card"]


def trk2_missing(spark: SparkSession, d: str) -> DataFrame:
    expected = spark.createDataFrame([(t,) for t in EXPECTED_TABLES], "table_name string")
    return ld.missing_tables(expected, ld.first_insert_on(Tables(spark, d).events, "event_type", "ts", TRACK_DAY))


def trk3_rebuild(spark: SparkSession, d: str) -> DataFrame:
    ev = Tables(spark, d).events
    earlier = ld.rebuild_tracking(ev.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")), "event_type", "ts")
    return ld.rebuild_tracking(ev, "event_type", "ts", existing=earlier)


def q1_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return ld.duplicate_keys(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


def q2_orphans(spark: SparkSession, d: str) -> DataFrame:
    m = Model(spark, d)
    return ld.orphans(m.customer, "CustomerSalesPersonId", m.salesperson, "SalesPersonId").select(
        "CustomerId", "CustomerName", "CustomerSalesPersonId"
    )


def q3_null_counts(spark: SparkSession, d: str) -> DataFrame:
    return ld.null_counts(Model(spark, d).trx)


def q4_surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    return ld.add_surrogate_key(Model(spark, d).orders, ["OrderId"], 0, "sk")


def hsh1_row_hash(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).customer
    return c.select(KEY, pr.row_hash(c, HASH_COLS).alias("row_hash"))


def _accounts(spark: SparkSession, d: str) -> DataFrame:
    c = Tables(spark, d).customer
    rib = F.concat(F.lit("FR76"), F.lpad(F.col(KEY).cast("string"), 10, "0"), F.lit(" "), F.col("c_name"))
    return c.select(F.col(KEY).alias("ID"), rib.alias("RIB"), F.lit(None).cast("string").alias("EncryptedRIB"))


def cry1_encrypt_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """ENC1 + CRY1 + CRY2: encrypt the missing values, decrypt them back."""
    keys = pr.key_frame(spark, DEMO_KEY)
    enc = ld.encrypt_missing(_accounts(spark, d), "RIB", "EncryptedRIB", keys)
    dec = enc.crossJoin(F.broadcast(keys)).select("ID", "RIB", pr.decrypt_column(F.col("EncryptedRIB"), F.col("__k")).alias("DecryptedRIB"))
    return dec


def cry2_decrypt_errors(spark: SparkSession, d: str) -> DataFrame:
    """CRY2: broken base64 and too-short data give the error token, the rest decrypts."""
    keys = pr.key_frame(spark, DEMO_KEY)
    enc = ld.encrypt_missing(_accounts(spark, d), "RIB", "EncryptedRIB", keys)
    k = F.col("ID") % 7
    # k = 0: four base64 characters cut off (length no longer a whole block); k = 1: too short for an IV
    cut = F.expr("substring(EncryptedRIB, 1, length(EncryptedRIB) - 4)")
    damaged = F.when(k == 0, cut).when(k == 1, F.lit("AAAA")).otherwise(F.col("EncryptedRIB"))
    j = enc.withColumn("EncryptedRIB", damaged).crossJoin(F.broadcast(keys))
    return j.select("ID", "RIB", pr.decrypt_column(F.col("EncryptedRIB"), F.col("__k")).alias("DecryptedRIB"))


def _ingest_records(spark: SparkSession, d: str) -> DataFrame:
    f = Model(spark, d).facturation
    return f.select("nid", "nshopid", dt.render_datetime("dinsertion").alias("dinsertion"), "sbillerid", "namount")


def jsn1_to_json(spark: SparkSession, d: str) -> DataFrame:
    r = _ingest_records(spark, d)
    return r.select("nid", pr.to_json_record(r).alias("record"))


def jsn2_default_field(spark: SparkSession, d: str) -> DataFrame:
    # The default field and its value.
    return pr.with_default_field(_ingest_records(spark, d), "dataSource", "FACTURATION1")


def jsn3_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    r = _ingest_records(spark, d)
    schema = r.schema
    back = r.select(pr.from_json_record(pr.to_json_record(r), schema).alias("j")).select("j.*")
    return back.withColumn("dinsertion", dt.parse_datetime("dinsertion"))


def agg16_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Ingest rollup: metric summed per day and dimensions (granularity 1 day)."""
    ev = Tables(spark, d).events
    return ev.groupBy(F.to_date("ts").alias("day"), "user_id", "event_type").agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"), F.count(F.lit(1)).alias("rows")
    )


def lak1_lake_report(spark: SparkSession, d: str) -> DataFrame:
    """Transaction report over the lake: its tables are written as CSV and read back as text."""
    m, base = Model(spark, d), scratch_path(spark, "lake", uuid.uuid4().hex)
    lake.store_tables({name: getattr(m, name) for name in lake.COLUMNS}, base)
    return lake.transaction_report(lake.open_tables(spark, base))


def jn7_not_in(spark: SparkSession, d: str) -> DataFrame:
    m = Model(spark, d)
    return null_aware_anti(m.employee, "EmployeeId", m.salesperson, "IdEmployeeSalesPerson").select("EmployeeId", "Employee_Name")


def srt6_top_keys(spark: SparkSession, d: str) -> DataFrame:
    return top_keys_by_count(Model(spark, d).simdata, "SimCustomerId", 5)


def fn_call_times(spark: SparkSession, d: str) -> DataFrame:
    """DAT1 / DAT2 / DAT3 / DAT6 / DAT8 / DAT9 / MTH1 over the call log."""
    cr = Model(spark, d).callrecords
    clock = F.date_format("CallStartTime", "HH:mm:ss")
    return cr.select(
        "CallId",
        clock.alias("StartClock"),
        dt.seconds_of_day(clock).alias("StartSecondOfDay"),
        dt.seconds_between("CallStartTime", "CallEndTime").alias("Seconds"),
        dt.year_difference(F.lit("1990-05-17").cast("date"), "CallStartTime").alias("YearsSince1990"),
        dt.add_months("CallStartTime", 3).alias("PlusThreeMonths"),
        dt.render_datetime("CallEndTime").alias("EndText"),
        F.date_format("CallStartTime", "yyyyMMdd").alias("DayStamp"),
        F.abs(F.col("CallDuration") - 2500).alias("GapTo2500"),
    )


QUERIES = {
    "ver1_initial_load": ver1_initial_load,
    "ver2_new_keys": ver2_new_keys,
    "ver2_new_keys_by_max": ver2_new_keys_by_max,
    "ver3_compare": ver3_compare,
    "ver4_since": ver4_since,
    "ver5_hash": ver5_hash,
    "ver6_change_report": ver6_change_report,
    "wmk1_advance": wmk1_advance,
    "stm1_stamp": stm1_stamp,
    "load2_incremental": load2_incremental,
    "load4_consolidate": load4_consolidate,
    "ups1_upsert": ups1_upsert,
    "jn12_lookup_route": jn12_lookup_route,
    "snap2_differential": snap2_differential,
    "snap3_restore": snap3_restore,
    "trk1_first_insert": trk1_first_insert,
    "trk2_missing": trk2_missing,
    "trk3_rebuild": trk3_rebuild,
    "q1_duplicate_keys": q1_duplicate_keys,
    "q2_orphans": q2_orphans,
    "q3_null_counts": q3_null_counts,
    "q4_surrogate_key": q4_surrogate_key,
    "hsh1_row_hash": hsh1_row_hash,
    "cry1_encrypt_roundtrip": cry1_encrypt_roundtrip,
    "cry2_decrypt_errors": cry2_decrypt_errors,
    "jsn1_to_json": jsn1_to_json,
    "jsn2_default_field": jsn2_default_field,
    "jsn3_json_roundtrip": jsn3_json_roundtrip,
    "agg16_rollup": agg16_rollup,
    "lak1_lake_report": lak1_lake_report,
    "jn7_not_in": jn7_not_in,
    "srt6_top_keys": srt6_top_keys,
    "fn_call_times": fn_call_times,
}
for _entity in cl.RULES:
    QUERIES[f"load3_clean_{_entity}"] = _clean_query(_entity)
