"""Sources, sinks and incremental reloads as queries: each writes to a scratch folder, does its work and reads back."""

from __future__ import annotations

import io
import urllib.error
from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.plans.aggregates import q, r3
from wattframe.plans.bindings import monthly, with_
from wattframe.plans.domain import staged_load
from wattframe.plans.joins import VERSIONS_SQL, versions
from wattframe.registry import query
from wattframe.session import scratch, table
from wattframe.sources import archives, calendar, loads, sinks, store, text
from wattframe.sources import versions as versions_of
from wattframe.streaming import incremental, landing

Z = C.ZONE


def _csv(spark, sf, name):
    path = scratch(spark, name)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("order_key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")).alias("total"))
    o.write.option("sep", ";").option("header", True).csv(path)
    return path


@query("select o_orderkey, o_orderdate::date as day, o_totalprice::decimal(18,2)::double as total from orders")
def src_01_delimited_text(spark, sf):
    raw = text.read_delimited(spark, _csv(spark, sf, "csv"), ["order_key", "day", "total"])
    return raw.select(C.strict("order_key", "bigint").alias("o_orderkey"), C.strict("day", "date").alias("day"), C.comma_decimal("total").alias("total"))


@query("select * from (values ('Preço (R$/MWh)', 'preco_r_mwh'), ('2º Período', 'c_2o_periodo'), ('  DATA  ', 'data')) t(raw, name)")
def src_02_header_names(spark, sf):
    """Names as they stand in a file's first line."""
    path, raw = scratch(spark, "headers"), ["Preço (R$/MWh)", "2º Período", "  DATA  "]
    rows = table(spark, sf, "nation").select(F.col("n_nationkey").alias(raw[0]), F.col("n_regionkey").alias(raw[1]), F.col("n_name").alias(raw[2]))
    rows.write.option("sep", ";").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    found = spark.read.option("sep", ";").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path).columns
    return spark.createDataFrame(list(zip(found, text.header_names(found), strict=True)), "raw string, name string")


@query("select 'N' || n_nationkey as station, n_name as region from nation")
def src_03_preamble(spark, sf):
    """Two lines of metadata before the rows of each file: a file for each nation, read back whole and by Spark."""
    path = scratch(spark, "preambles")
    lines = F.array_join(F.array(F.concat(F.lit("REGION:;"), "n_name"), F.concat(F.lit("STATION:;N"), F.col("n_nationkey").cast("string")), F.lit("DAY;VALUE"), F.lit("2020-01-01;1,5")), "\n")
    table(spark, sf, "nation").select(lines.alias("value"), F.col("n_nationkey").alias("file")).repartition("file").write.partitionBy("file").text(path)
    read = spark.read.text(path, wholetext=True).select("value")

    def parsed(batches):
        for pdf in batches:
            metas = [text.preamble(v.split("\n"), 2) for v in pdf["value"]]
            yield pd.DataFrame({"station": [m["station"] for m in metas], "region": [m["region"] for m in metas]})

    return read.mapInPandas(parsed, "station string, region string")


@query("select n_nationkey::varchar as station, n_name as name, (n_nationkey * 1.5)::double as t from nation")
def src_04_station_archives(spark, sf):
    """Archives of four nations each: latin-1, a preamble of two lines, a header and a row with a trailing separator."""
    key, path = F.col("n_nationkey"), scratch(spark, "zips")
    value = F.replace((key * 1.5).cast("string"), F.lit("."), F.lit(","))
    lines = F.array(F.concat(F.lit("CODE:;"), key.cast("string")), F.concat(F.lit("NAME:;"), "n_name"), F.lit("TEMPERATURE;HOUR;"), F.concat(value, F.lit(";00;")))
    rows = table(spark, sf, "nation").select(F.floor(key / 4).alias("archive"), F.format_string("%03d.csv", key.cast("int")).alias("member"), F.posexplode(lines).alias("line", "text"))
    archives.write_archives(rows, path, "archive", "member", "line", "text").count()
    read = archives.read_archives(spark, path, ["temperature", "hour"], lines=2)
    return read.select(F.col("preamble")["code"].alias("station"), F.col("preamble")["name"].alias("name"), C.comma_decimal("temperature").alias("t"))


@query("select strftime(o_orderdate, '%Y-%m') || '.csv' as member, strftime(o_orderdate, '%Y') as year, o_orderkey as id, o_totalprice::decimal(18,2)::double as total from orders")
def src_04b_order_archives(spark, sf):
    """An archive for each year with a member for each month; a task reads a run of members, whatever the archive."""
    path, o = scratch(spark, "zips"), table(spark, sf, "orders")
    rows = o.select(F.year("o_orderdate").alias("archive"), F.date_format("o_orderdate", "yyyy-MM'.csv'").alias("member"), F.col("o_orderkey").alias("line"), F.concat(F.col("o_orderkey").cast("string"), F.lit(";"), F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))).alias("text"))
    head = rows.select("archive", "member").distinct().select("archive", "member", F.posexplode(F.array(F.concat(F.lit("YEAR:;"), F.col("archive").cast("string")), F.lit("ORDER;TOTAL"))).alias("place", "text"))
    lines = rows.union(head.select("archive", "member", (F.col("place") - 2).cast("long"), "text"))
    archives.write_archives(lines, path, "archive", "member", "line", "text").count()
    read = archives.read_archives(spark, path, ["order", "total"], lines=1, split_bytes=1 << 20)
    return read.select("member", F.col("preamble")["year"].alias("year"), C.strict("order", "bigint").alias("id"), C.comma_decimal("total").alias("total"))


@query("select o_orderkey as id from orders where year(o_orderdate) = 1996")
def src_06_yearly_files(spark, sf):
    """A folder per year with a declared layout: one year is read without touching the others."""
    path = scratch(spark, "years")
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")).write.partitionBy("year").parquet(path)
    read = text.check_columns(spark.read.parquet(path), ["o_orderkey", "o_totalprice", "year"])
    return read.filter("year = 1996").select(F.col("o_orderkey").alias("id"))


@query("select date_trunc('month', o_orderdate)::date as month, count(*)::bigint as n from orders where year(o_orderdate) = 1997 group by 1")
def src_07_month_range(spark, sf):
    o = table(spark, sf, "orders").filter("year(o_orderdate) = 1997").select(C.month_of("o_orderdate").alias("month"))
    return text.check_months(o, "month", date(1997, 1, 1), date(1997, 12, 1)).groupBy("month").agg(F.count("*").alias("n"))


@query("select event_id, case when event_id % 3 <> 0 then (props->>'$.k')::bigint end as k from events")
def src_09_repaired_json(spark, sf):
    broken = F.when(F.col("event_id") % 3 == 0, F.lit('{"k": , "x": 1}')).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", F.from_json(text.repaired_json(broken), "k bigint")["k"].alias("k"))


@query("select * from (values (1995, 40.0::double), (1996, 42.5::double)) t(year, floor)")
def src_10_seeds(spark, sf):
    path = scratch(spark, "seed")
    spark.createDataFrame([(1995, 40.0), (1996, 42.5)], "year int, floor double").write.option("header", True).csv(path)
    return spark.read.schema("year int, floor double").option("header", True).option("mode", "FAILFAST").csv(path)


@query("select * from (values ('SE', 1), ('S', 2), ('NE', 3), ('N', 4)) t(code, place)")
def src_11_inline_table(spark, sf):
    rows = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(i + 1).alias("place")) for i, c in enumerate(["SE", "S", "NE", "N"])])
    return spark.range(1).select(F.inline(rows))


@query("select strftime(unnest(generate_series(timestamp '2020-01-01', timestamp '2020-12-31 23:00:00', interval 1 hour)), '%Y-%m-%d %H') as utc")
def src_12_hour_grid(spark, sf):
    return calendar.hours(spark, "2020-01-01 00:00:00", "2020-12-31 23:00:00").select(F.date_format("utc", "yyyy-MM-dd HH").alias("utc"))


@query("select unnest(range(2001, 2021))::bigint as year")
def src_13_integer_range(spark, sf):
    return spark.range(2001, 2021).select(F.col("id").alias("year"))


@query("select distinct strftime(o_orderdate, '%Y-%m') as month, strftime(o_orderdate, '%Y-%m') = (select max(strftime(o_orderdate, '%Y-%m')) from orders) as is_last from orders")
def src_14_partition_scan(spark, sf):
    path = scratch(spark, "months")
    table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).write.partitionBy("month").parquet(path)
    found = sinks.partitions(spark, path, "month")
    return spark.createDataFrame([(m, m == found[-1]) for m in found], "month string, is_last boolean")


@query("with n as (select event_id, event_type, ts from events where event_type = 'purchase' order by ts desc, event_id desc limit 20) select event_id, strftime(ts, '%Y-%m-%d %H:%M') as started, floor(epoch(ts))::bigint as seconds from events where event_id in (select event_id from n)")
def src_15_run_metadata(spark, sf):
    e = table(spark, sf, "events")
    n = e.filter("event_type = 'purchase'").orderBy(F.desc("ts"), F.desc("event_id")).limit(20).select("event_id")
    return e.join(n, "event_id", "left_semi").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("started"), F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("seconds"))


@query(with_("monthly") + "select market, month, value from monthly where month between date '1996-01-01' and date '1998-12-01' and value > 0 order by market, month")
def src_16_monthly_csv_slice(spark, sf):
    path = scratch(spark, "monthly")
    monthly(spark, sf).select("market", "month", "value").write.option("header", True).option("sep", ";").csv(path)
    raw = spark.read.schema("market string, month date, value double").option("header", True).option("sep", ";").option("mode", "FAILFAST").csv(path)
    cut = raw.filter(F.col("month").between(F.lit("1996-01-01").cast("date"), F.lit("1998-12-01").cast("date")))
    if not cut.filter("value <= 0").isEmpty():
        raise text.LayoutError("values must be positive")
    return cut.orderBy("market", "month")


@query("select 'load-' || y || '.csv' as file from (select unnest(range(1995, 2004)) as y) where y not in (select year(o_orderdate) from orders)")
def src_17_missing_files(spark, sf):
    name = lambda y: F.concat(F.lit("load-"), y.cast("string"), F.lit(".csv")).alias("file")
    expected = spark.range(1995, 2004).select(name(F.col("id")))
    return text.missing_files(expected, table(spark, sf, "orders").select(name(F.year("o_orderdate"))).distinct())


@query()
def src_05_download_retry(spark, sf):
    """The waits of a download that two busy answers delay; nothing is fetched from here."""
    waits, answers = [], [503, 429, None]

    def opener(url):
        code = answers[len(waits)]
        if code:
            raise urllib.error.HTTPError(url, code, "busy", {}, None)
        return io.BytesIO(b"ok")

    body = text.download("http://localhost/file", opener=opener, sleep=waits.append)
    return spark.createDataFrame([(i, float(w), body.decode()) for i, w in enumerate(waits)], "attempt int, wait double, body string")


ORDERS_MONTH = "select o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') as month from orders"


def _orders_by_month(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@query(f"select * from ({ORDERS_MONTH}) where month < '1996-01' union all select * from ({ORDERS_MONTH}) where month = '1997-05'")
def snk_01_replace_and_append(spark, sf):
    path, o = scratch(spark, "table"), _orders_by_month(spark, sf)
    sinks.replace_table(o, path)
    sinks.replace_table(o.filter("month < '1996-01'"), path)
    sinks.append_table(o.filter("month = '1997-05'"), path)
    return spark.read.parquet(path)


@query(f"select o_orderkey, case when month = '1996-02' then o_totalprice + 1 else o_totalprice end as o_totalprice, month from ({ORDERS_MONTH})")
def snk_02_replace_one_partition(spark, sf):
    """A reader sees the old partition or the new one, at any moment."""
    orders, o = versions_of.Table(spark, scratch(spark, "table"), "month"), _orders_by_month(spark, sf)
    orders.replace(o)
    orders.replace_partitions(o.filter("month = '1996-02'").withColumn("o_totalprice", F.col("o_totalprice") + 1), ["1996-02"])
    return orders.read()


@query(f"select month, count(*)::bigint as n from ({ORDERS_MONTH}) group by 1")
def snk_03_parallel_load(spark, sf):
    """A load for each year, several at once, each to a folder of its own; counts are read back."""
    path = scratch(spark, "table")
    outcomes = loads.parallel(spark, _year_loads(spark, sf, path))
    failed = [o for o in outcomes if o.state != "done"]
    if failed:
        raise RuntimeError(f"loads failed: {failed}")
    return spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(F.count("*").alias("n"))


def _year_loads(spark, sf, path, broken=None):
    """One load for each year of the orders; that of the broken year meets a row that it can't cast."""
    o = _orders_by_month(spark, sf).withColumn("year", F.substring("month", 1, 4))
    years = [r.year for r in o.select("year").distinct().orderBy("year").collect()]  # a row for each year

    def load(year):
        rows = o.filter(F.col("year") == year).drop("year")
        if year == broken:
            rows = rows.withColumn("o_orderkey", C.strict(F.concat(F.col("o_orderkey").cast("string"), F.lit("?")), "bigint"))
        sinks.replace_table(rows, f"{path}/year={year}")

    return {year: lambda year=year: load(year) for year in years}


@query(f"select month[1:4] as year, case when month[1:4] = '1996' then 'failed' else 'done' end as state, case when month[1:4] = '1996' then 0 else count(*) end::bigint as n from ({ORDERS_MONTH}) group by 1")
def snk_03b_load_report(spark, sf):
    """One load of several fails: the report names it, and the others' rows stand."""
    path = scratch(spark, "table")
    outcomes = loads.report(spark, loads.parallel(spark, _year_loads(spark, sf, path, "1996")))
    stands = spark.read.parquet(path).groupBy(F.col("year").cast("string").alias("name")).agg(F.count("*").alias("n"))
    return outcomes.join(stands, "name", "left").select(F.col("name").alias("year"), "state", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query("select true as refused")
def snk_04_partition_guard(spark, sf):
    path, o = scratch(spark, "table"), _orders_by_month(spark, sf)
    sinks.replace_table(o.filter("month < '1995-03'"), path, "month")
    try:
        sinks.check_partitioned(spark, path, "year")
        refused = False
    except sinks.PartitionError:
        refused = True
    return spark.createDataFrame([(refused,)], "refused boolean")


@query(f"select * from ({ORDERS_MONTH}) where month <> '1996-04'")
def snk_05_overwrite_listed_partitions(spark, sf):
    """A listed partition that got no rows is emptied."""
    path, o = scratch(spark, "table"), _orders_by_month(spark, sf)
    sinks.replace_table(o, path, "month")
    sinks.replace_partitions(o.filter("month = '1996-03'"), path, "month", ["1996-03", "1996-04"])
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", F.col("month").cast("string").alias("month"))


@query("select c_custkey, case when c_custkey % 10 = 0 then c_acctbal + 1000 else c_acctbal end as c_acctbal from customer union all select c_custkey + 1000000, 0.0 from customer where c_custkey % 100 = 0")
def snk_06_upsert(spark, sf):
    customers = versions_of.Table(spark, scratch(spark, "table"))
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    customers.replace(c)
    changed = c.filter("c_custkey % 10 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    new = c.filter("c_custkey % 100 = 0").select(F.col("c_custkey") + 1000000, F.lit(0.0)).toDF("c_custkey", "c_acctbal")
    customers.upsert(changed.union(new), ["c_custkey"])
    return customers.read()


@query("select r_regionkey, r_name, null::varchar as note from region union all select 99, 'X', 'new'")
def snk_07_add_columns(spark, sf):
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    more = spark.createDataFrame([(99, "X", "new")], "r_regionkey int, r_name string, note string")
    return sinks.add_columns(r, more)


@query("select 'r_regionkey,r_name' || chr(10) || string_agg(r_regionkey || ',' || r_name, chr(10) order by r_regionkey) || chr(10) as csv from region")
def snk_08_csv_export(spark, sf):
    return spark.createDataFrame([(sinks.csv_text(table(spark, sf, "region").select("r_regionkey", "r_name"), ["r_regionkey"]),)], "csv string")


@query("select unnest(range(0, 5))::bigint as run, 'done' as state")
def snk_09_json_log(spark, sf):
    path = scratch(spark, "log")
    for k in range(5):
        spark.createDataFrame([(k, "done")], "run bigint, state string").write.mode("append").json(path)
    return spark.read.schema("run bigint, state string").json(path)


def _region_files(rows):
    return rows.select(F.concat(F.lit("region="), F.col("r_regionkey").cast("string")).alias("file"), F.col("r_name").cast("binary").alias("content"))


@query("select 'region=' || r_regionkey as file, case when r_regionkey = 0 then 'new' when r_regionkey = 1 then 'changed' else 'same' end as action from region")
def snk_10_content_sync(spark, sf):
    """The second sync of a store of files: one file is new, one changed."""
    r, archive = table(spark, sf, "region").select("r_regionkey", "r_name"), store.Store(spark, scratch(spark, "store"))
    archive.sync(_region_files(r.filter("r_regionkey <> 0").withColumn("r_name", F.when(F.col("r_regionkey") == 1, F.concat("r_name", F.lit("!"))).otherwise(F.col("r_name")))))
    return archive.sync(_region_files(r))


@query("select 'region=' || r_regionkey as file, v::int as version, case when v = 2 then r_name || '!' else r_name end as content from region, (values (1), (2), (3)) t(v) where v = 1 or r_regionkey = 1")
def snk_10b_archived_versions(spark, sf):
    """Three syncs: a file changes and changes back; every version is read back, contents that are equal are one."""
    r, archive = table(spark, sf, "region").select("r_regionkey", "r_name"), store.Store(spark, scratch(spark, "store"))
    for mark in ("", "!", ""):
        archive.sync(_region_files(r.withColumn("r_name", F.when(F.col("r_regionkey") == 1, F.concat("r_name", F.lit(mark))).otherwise(F.col("r_name")))))
    return archive.read().select("file", "version", F.col("content").cast("string").alias("content"))


@query("select n_nationkey, n_name, n_regionkey from nation")
def snk_11_parquet_round_trip(spark, sf):
    path = scratch(spark, "frozen")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    sinks.replace_table(n, path)
    return spark.read.schema(n.schema).parquet(path)


@query("select 'nation' as name, (select count(*) from nation)::bigint as rows, true as within_limit union all select 'region', (select count(*) from region)::bigint, true")
def snk_12_manifest(spark, sf):
    return sinks.manifest(spark, {t: table(spark, sf, t) for t in ("region", "nation")}).drop("fingerprint")


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders where o_orderdate < (select max(o_orderdate) from orders)")
def snk_13_delete_latest(spark, sf):
    orders = versions_of.Table(spark, scratch(spark, "table"))
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    orders.replace(o)
    last = o.agg(F.max("day").alias("d")).first().d
    orders.delete(F.col("day") == last)
    return orders.read()


@query(f"select month, count(*)::bigint as n from ({ORDERS_MONTH}) where month not in ('1995-01', '1999-07') group by 1")
def snk_14_drop_partitions(spark, sf):
    path = scratch(spark, "table")
    sinks.replace_table(_orders_by_month(spark, sf), path, "month")
    sinks.drop_partitions(spark, path, "month", ["1995-01", "1999-07"])
    return spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(F.count("*").alias("n"))


@query(f"select layout, count(*)::bigint as n, {q('sum(o_totalprice)', 2)} as total from orders, (values ('plain'), ('partitioned'), ('sorted')) l(layout) group by 1")
def snk_15_layout_variants(spark, sf):
    o, out = _orders_by_month(spark, sf), None
    for layout in ("plain", "partitioned", "sorted"):
        path = scratch(spark, layout)
        rows = o.sortWithinPartitions("o_orderkey") if layout == "sorted" else o
        sinks.replace_table(rows, path, "month" if layout == "partitioned" else None)
        part = spark.read.parquet(path).agg(F.count("*").alias("n"), r3(F.sum("o_totalprice"), 2).alias("total")).select(F.lit(layout).alias("layout"), "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


@query("select count(*)::bigint as n, count(distinct year(o_orderdate))::bigint as years from orders")
def snk_16_full_load(spark, sf):
    """One write for all the years that the data has, each in its own partition: a year more needs no change here."""
    path = scratch(spark, "full")
    sinks.replace_table(table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")), path, "year")
    return spark.read.parquet(path).agg(F.count("*").alias("n"), F.count_distinct("year").alias("years"))


ORDER_MONTHS_SQL = "m as (select date_trunc('month', o_orderdate)::date as month, count(*)::bigint as n from orders where o_orderdate is not null group by 1)"


def _order_months(spark, sf):
    """Orders a month: one row for each month of the calendar that has any."""
    return table(spark, sf, "orders").filter("o_orderdate is not null").groupBy(C.month_of("o_orderdate").alias("month")).agg(F.count("*").alias("n"))


@query(f"""with {ORDER_MONTHS_SQL}
select a.month as reference, (a.month - interval 2 month)::date as first, a.month as last, 4::int as partitions, sum(b.n)::bigint as n_rows
from m a join m b on b.month between a.month - interval 2 month and a.month group by a.month""")
def inc_01_usual_window(spark, sf):
    """The usual reload as of every month that has orders, and the rows it reloads."""
    months = _order_months(spark, sf)
    windows = [incremental.usual_reload(r.month, None) for r in months.select("month").collect()]  # a row a month of the calendar
    rows = [(w.last, w.first, w.last, len(w.partitions), w.local_months) for w in windows]
    usual = spark.createDataFrame(rows, "reference date, first date, last date, partitions int, months array<date>")
    reloaded = usual.withColumn("month", F.explode("months")).join(months, "month")
    return reloaded.groupBy("reference", "first", "last", "partitions").agg(F.sum("n").alias("n_rows"))


@query("select (date '2017-01-01' + k * interval 1 month)::date as first, size::int as size, true as reads_enough, true as replaces_enough from (select unnest(range(24)) as k) cross join (select unnest(range(1, 4)) as size)")
def inc_02_window_rules(spark, sf):
    """Every window of two years: read months cover the replaced partitions, partitions cover the reloaded months."""
    rows = []
    for k in range(24):
        for size in (1, 2, 3):
            w = incremental.Reload(incremental.shift(date(2017, 1, 1), k), incremental.shift(date(2017, 1, 1), k + size - 1))
            rows.append((w.first, size, set(w.local_months) <= set(w.read_months), w.bounds[0] <= w._utc(w.first) and w._utc(incremental.shift(w.last, 1)) <= w.bounds[1]))
    return spark.createDataFrame(rows, "first date, size int, reads_enough boolean, replaces_enough boolean")


INC_SQL = f"""with t as (select o_orderpriority as area, o_orderdate as local, o_totalprice::decimal(18,2)::double as load, o_orderkey as loaded from orders)
select area, strftime(timezone('UTC', timezone('{Z}', local)), '%Y-%m-%d %H') as utc, load from t where timezone('{Z}', timezone('{Z}', local)) = local qualify row_number() over (partition by area, timezone('{Z}', local) order by loaded desc, load desc) = 1"""


@query(INC_SQL)
def inc_03_backfill_equals_full(spark, sf):
    """A full load of all but some months' latest values, then a backfill: the table is as if loaded at once."""
    path = scratch(spark, "staged")
    o = table(spark, sf, "orders")
    raw = o.select(F.col("o_orderpriority").alias("area"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("local"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("load"), F.col("o_orderkey").alias("loaded"))
    old = raw.withColumn("load", F.when(F.col("local").between("1997-03-01", "1997-05-99"), F.lit("0.00")).otherwise(F.col("load")))
    stage = lambda df: staged_load(df).select("area", "utc", "load")
    incremental.reload_table(spark, old, path, incremental.Reload(date(1995, 1, 1), date(2001, 12, 1)), stage)
    incremental.reload_table(spark, raw, path, incremental.backfill(date(1997, 3, 10), date(1997, 5, 2)), stage)
    return spark.read.parquet(path).select("area", F.date_format("utc", "yyyy-MM-dd HH").alias("utc"), "load")


@query(f"with {ORDER_MONTHS_SQL} select month as missing, month > min(month) over () and month < max(month) over () as refused from m")
def inc_04_window_validation(spark, sf):
    """Whether the usual reload is refused if a month of the orders were missing: at the ends of the table none is."""
    have = {r.month for r in _order_months(spark, sf).select("month").collect()}

    def refused(month):
        try:
            incremental.usual_reload(month, None).check(have - {month})
        except ValueError:
            return True
        return False

    return spark.createDataFrame([(m, refused(m)) for m in sorted(have)], "missing date, refused boolean")


@query("select true as outside, false as inside")
def inc_05_revision_guard(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("local"), F.col("value").alias("v"), F.col("event_type").alias("l"))
    new = e.withColumn("v", F.when(F.col("id") == 1, F.col("v") + 1).otherwise(F.col("v")))
    window = lambda y: incremental.Reload(date(y, 1, 1), date(y, 2, 1))
    rows = [(incremental.must_reload(e, new, ["id", "local"], "v", "l", "local", window(2023)), incremental.must_reload(e, new, ["id", "local"], "v", "l", "local", window(2024)))]
    return spark.createDataFrame(rows, "outside boolean, inside boolean")


@query(f"select change, count(*)::bigint as n from ({VERSIONS_SQL}) group by 1")
def inc_06_revision_classes(spark, sf):
    return versions(spark, sf).groupBy("change").agg(F.count("*").alias("n"))


@query("select 'part-' || r_regionkey as file from region where r_regionkey in (0, 1)")
def inc_07_new_files(spark, sf):
    """A landing folder, loaded; then one file comes, one grows, and one is written again as it was."""
    folder, r = scratch(spark, "landing"), table(spark, sf, "region").select("r_regionkey", "r_name")
    area = landing.Landing(spark, folder, scratch(spark, "state"), r"file=([^/]+)/part-[^/]*$")

    def put(rows):
        files = rows.select(F.col("r_name").alias("value"), F.concat(F.lit("part-"), F.col("r_regionkey").cast("string")).alias("file"))
        files.repartition("file").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").text(folder)

    put(r.filter("r_regionkey > 0"))
    area.load(lambda files: None)
    put(r.filter("r_regionkey < 3").withColumn("r_name", F.when(F.col("r_regionkey") < 2, F.concat("r_name", F.lit(" and more"))).otherwise(F.col("r_name"))))
    return area.load(lambda files: None).filter("kind <> 'touched'").select("file")


@query("select * from (values (1, 'raw_load'), (2, 'stg_load'), (3, 'fact_load'), (4, 'fact_monthly')) t(place, name)")
def inc_08_selective_rebuild(spark, sf):
    edges = {"raw_load": ["stg_load"], "stg_load": ["fact_load"], "fact_load": ["fact_monthly"], "raw_price": ["stg_price"]}
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(incremental.descendants(edges, "raw_load"))], "place int, name string")


@query("select event_type, strftime(ts, '%Y-%m') as month, count(*)::bigint as n from events group by 1, 2")
def inc_09_stream_append(spark, sf):
    """The same staging as a file stream, run until its input is used up."""
    source, path, checkpoint = scratch(spark, "source"), scratch(spark, "stream"), scratch(spark, "offsets")
    e = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").alias("utc"))
    e.repartition(3).write.parquet(source)
    done = incremental.stream_table(spark, source, "event_id bigint, event_type string, utc timestamp_ntz", path, checkpoint, lambda df: df)
    done.awaitTermination()
    return spark.read.parquet(path).groupBy("event_type", F.col("month").cast("string").alias("month")).agg(F.count("*").alias("n"))
