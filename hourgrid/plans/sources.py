"""Queries that write files from the test tables and read them with the library's readers."""

from __future__ import annotations

import gzip
import tarfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from hourgrid import files, sinks
from hourgrid.functions import positions
from hourgrid.operators import curves, export, gas, quality
from hourgrid.plans import views as v
from hourgrid.plans.registry import query
from hourgrid.plans.views import CALENDAR, SCENARIO, define
from hourgrid.session import scratch_path
from hourgrid.sinks import packed
from hourgrid.sources import archives, datasource, tables

# bounds of one file, whatever the size of the tables
ARCHIVE_ROWS = 20_000
PRICE_ROWS = 8_760
# sites side by side in a wide file, other ones in each scenario
WIDE_SITES = {"F": 64, "O": 48}
# columns of a wide file of one run
WIDE_TILE = 400
# member positions of the test tables end here
POSITIONS = 1_000_003


def _joined(parts: list, sep: str) -> pa.Array:
    return pc.binary_join_element_wise(*[pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in [*parts, sep]])


def _csv_lines(group: pa.Table, columns: list[str]) -> pa.Array:
    """A CSV line for each row, its place in the group as label."""
    parts = [pa.array(range(group.num_rows)).cast(pa.large_string())]
    for name in columns:
        text = pc.fill_null(group.column(name).combine_chunks().cast(pa.large_string()), "")
        special = pc.match_substring_regex(text, '[,"\\r\\n]')
        if pc.any(special).as_py():
            text = pc.if_else(special, _joined(['"', pc.replace_substring(text, '"', '""'), '"'], ""), text)
        parts.append(text)
    return _joined([_joined(parts, ","), "\n"], "")


def _members(group: pa.Table, key: str, order: list[str]) -> Iterator[tuple[str, bytes]]:
    """Name and CSV text of each member of an archive, by the first of its rows in their order; a column without a value in it is left out.

    The lines of all members are made at once; those of one are a slice of their bytes.
    """
    columns = [c for c in group.column_names if c not in ("scenario_id", "block", key, *order)]
    group = group.filter(group.column(key).is_valid()).sort_by([(c, "ascending") for c in order])
    names = group.column(key).combine_chunks().dictionary_encode()  # codes by first appearance
    place = np.argsort(names.indices.to_numpy(), kind="stable")
    group, code = group.take(pa.array(place)), names.indices.to_numpy()[place]
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    # the columns with a value in a member, a bit each
    held = np.zeros(len(starts), np.int64)
    for k, c in enumerate(columns):
        held |= np.logical_or.reduceat(group.column(c).is_valid().to_numpy(), starts).astype(np.int64) << k
    made: dict[int, tuple[bytes, np.ndarray, memoryview]] = {}
    for member, first, end, bits in zip(names.dictionary.to_pylist(), starts.tolist(), [*starts[1:].tolist(), len(code)], held.tolist()):
        if bits not in made:
            chosen = [c for k, c in enumerate(columns) if bits >> k & 1]
            lines = _csv_lines(group, chosen)
            _, offsets, data = lines.buffers()
            made[bits] = f",{','.join(chosen)}\n".encode(), np.frombuffer(offsets, np.int64), memoryview(data)
        header, at, data = made[bits]
        yield member, b"".join([header, data[at[first] : at[end]]])


def _archived(spark, rows, key, order, name):
    """Archives below a fresh folder, one tar.gz per ``block`` in the folder of its scenario, with a CSV member for each value of ``key``; members by ``order``."""
    folder = scratch_path(spark, name)

    def pack(group: pa.Table) -> pa.Table:
        place = "/".join(str(group.column(c)[0].as_py()) for c in ("scenario_id", "block"))
        with files.open_output(f"{folder}/{place}.tar.gz") as out, gzip.GzipFile("", "wb", 6, out, 0) as zipped:
            for member, data in _members(group, key, order):
                info = tarfile.TarInfo(f"{member}.csv")
                info.size = len(data)
                zipped.write(b"".join([info.tobuf(), data, bytes(-len(data) % tarfile.BLOCKSIZE)]))
            zipped.write(bytes(2 * tarfile.BLOCKSIZE))
        return pa.table({"n": pa.array([1], pa.int32())})

    rows.groupBy("scenario_id", "block").applyInArrow(pack, "n int").write.format("noop").mode("overwrite").save()
    return folder


def _written(spark, d):
    """All asset rows, archived by scenario and block of member positions."""
    rows = v.asset_row(spark, d)
    span = max(1, POSITIONS * ARCHIVE_ROWS // max(1, v.table(spark, d, "lineitem").count()))
    blocks = rows.withColumn("block", F.floor(F.col("member_pos") / span))
    return _archived(spark, blocks, "member", ["member_pos", "row_idx"], "series")


ARCHIVE_KEYS = {"scenario_id": r"/([FO])/\d+\.tar\.gz$", "block": r"/[FO]/(\d+)\.tar\.gz$"}


def _placed(rows, *columns):
    """Positions go on from block to block."""
    place = (F.col("block").cast("long") * (1 << 32) + F.col("member_pos")).alias("member_pos")
    return rows.select("scenario_id", F.regexp_replace("member", r"\.csv$", "").alias("member"), place, "row_idx", *columns)


def _raw(spark, d):
    rows = archives.site_records(spark, f"{_written(spark, d)}/*")  # few folders to list, however many archives
    keyed = rows.withColumns({name: F.regexp_extract("path", pattern, 1) for name, pattern in ARCHIVE_KEYS.items()})
    return _placed(keyed, "assetName", "assetClass", "carrierId", "sector", "allocationPower")


@query("src1_archive_members", """SELECT scenario_id, member, CAST(row_number() OVER (PARTITION BY scenario_id, member ORDER BY row_idx) - 1 AS BIGINT) AS row_idx,
    "assetName", "carrierId", round("allocationPower" / 1e6, 2) + 0.0 AS mw FROM asset_row""")
def src1(spark, d):
    rows = _raw(spark, d).withColumn("mw", F.round(F.col("allocationPower") / 1e6, 2))
    return rows.select("scenario_id", "member", "row_idx", "assetName", "carrierId", "mw")


@query("src12_first_member", """SELECT scenario_id, member, CAST(count(*) AS BIGINT) AS n FROM asset_row f
    WHERE (scenario_id, member_pos) IN (SELECT (scenario_id, min(member_pos)) FROM asset_row WHERE member LIKE 'M1%' GROUP BY scenario_id) GROUP BY ALL""")
def src12(spark, d):
    """Members are chosen by the source; each archive is read up to its first one."""
    rows = datasource.scan(spark, f"{_written(spark, d)}/*/*.tar.gz", ["assetName"], ARCHIVE_KEYS, first_member=True, where=F.col("member").startswith("M1"))
    found = archives.first_member(_placed(rows), "M1", ["scenario_id"])
    return found.groupBy("scenario_id", "member").agg(F.count("*").alias("n"))


@query("src12_pushed_filters", """SELECT scenario_id, member, "assetName", CAST(count(*) AS BIGINT) AS n, round(sum("allocationPower") / 1e6, 2) + 0.0 AS mw
    FROM asset_row WHERE scenario_id = 'F' AND member LIKE 'M2%' GROUP BY ALL""")
def src12_pushed(spark, d):
    """One scenario's archives are opened, and of their members those with a prefix parsed."""
    chosen = F.col("member").startswith("M2") & (F.col("scenario_id") == "F")
    rows = datasource.scan(spark, f"{_written(spark, d)}/*/*.tar.gz", ["assetName", "allocationPower"], ARCHIVE_KEYS, where=chosen)
    sums = _placed(rows, "assetName", "allocationPower").groupBy("scenario_id", "member", "assetName")
    return sums.agg(F.count("*").alias("n"), F.round(F.sum(F.col("allocationPower").cast("double")) / 1e6, 2).alias("mw"))


@query("snk2_packed_archives", "SELECT scenario_id, carrier, hour, site, round(mw, 4) + 0.0 AS mw FROM gas_curve")
def snk2_packed(spark, d):
    """Gas curves as an archive per scenario with a member per carrier, read back in parts by the archive reader; a line's row label is its hour."""
    folder = scratch_path(spark, "gas-archives")
    manifest = packed.write_archives(v.gas_curve(spark, d), folder, ["scenario_id"])
    cells = archives.read_cells(spark, manifest, sep=";", keep_label=True, missing=False).where("value IS NOT NULL")
    carrier = F.regexp_replace("member", r"\.csv$", "").alias("carrier")
    hour = archives.number(F.col("label")).cast("int").alias("hour")
    return cells.select(F.regexp_extract("path", "scenario_id=([^/]+)", 1).alias("scenario_id"), carrier, hour, F.col("column").alias("site"), F.col("value").alias("mw"))


@query("snk1_wide_files_per_run", "SELECT scenario_id, hour, scenario_id || '-' || site AS site, round(mw, 4) + 0.0 AS mw FROM site_curve")
def snk1_wide(spark, d):
    """All site curves as wide files with the nodes of each run as columns, tiled, read back by the reader of wide files."""
    folder = scratch_path(spark, "wide-runs")
    named = v.site_curve(spark, d).withColumn("site", F.concat_ws("-", "scenario_id", "site"))
    manifest = packed.write_wide_files(named, folder, ["scenario_id"], node="site", tile=WIDE_TILE)
    paths = [r["path"] for r in manifest.select("path").collect()]  # one per scenario and tile
    cells = archives.read_wide_files(spark, paths).where(F.col("mw").isNotNull())
    return cells.select(F.regexp_extract("path", "scenario_id=([^/]+)", 1).alias("scenario_id"), "hour", "site", "mw")


define("export_site", """SELECT 'S' || k AS site, 'N' || chr(CAST(65 + k % 25 AS INTEGER)) || CASE WHEN k % 3 = 0 THEN '150' ELSE '25' END AS substation,
    'Sector ' || (k % 3) AS sector FROM range(40) AS r(k)""")


def _export_sites(spark):
    k = F.col("id")
    volt = F.when(k % 3 == 0, F.lit("150")).otherwise(F.lit("25"))
    return spark.range(40).select(
        F.concat(F.lit("S"), k.cast("string")).alias("site"), F.concat(F.lit("N"), F.char(65 + k % 25), volt).alias("substation"),
        F.concat(F.lit("Sector "), (k % 3).cast("string")).alias("sector"),
    )


define("e1_row", "SELECT * FROM numbered WHERE carrier = 'electricity'")
define("e1_limit", """SELECT scenario_id, arg_min(n, rk) AS lim FROM (
    SELECT *, row_number() OVER (PARTITION BY scenario_id ORDER BY member_pos, first_idx) AS rk FROM (
    SELECT scenario_id, member_pos, count(*) AS n, min(row_idx) AS first_idx FROM e1_row GROUP BY scenario_id, member, member_pos, "assetName", "carrierId"))
    GROUP BY ALL""")
define("e1_net", """SELECT f.scenario_id, hour, CASE WHEN s.substation LIKE '%25' THEN left(s.substation, 2) || '150' ELSE s.substation END AS node, s.sector, sum(mw) AS mw
    FROM e1_row f JOIN e1_limit h ON f.scenario_id = h.scenario_id JOIN last_name n ON f."assetName" = n.raw_name JOIN export_site s ON n.grid_name = s.site
    WHERE hour < lim GROUP BY ALL""")


@query("e1_archive_to_nodal_curves", """SELECT scenario_id, CAST(hour AS INTEGER) AS hour, node, sector, product,
    round(CASE product WHEN 'Demand' THEN greatest(mw, 0) ELSE greatest(-mw, 0) END, 2) + 0.0 AS mw FROM e1_net, (VALUES ('Demand'), ('Supply')) AS p(product)""")
def e1(spark, d):
    """Archives to routed and named site curves to demand and supply per node."""
    site_curves = export.export_site_curves(_raw(spark, d), v.site_name(spark, d), by=SCENARIO)
    electricity = site_curves.where((F.col("carrier") == "electricity") & F.col("site").isNotNull())
    nodal = curves.nodal_sector_curves(electricity.select("scenario_id", "hour", "site", "mw"), _export_sites(spark), by=SCENARIO)
    return nodal.withColumn("mw", F.round("mw", 2))


@query("e2_balanced_gas_stage", f"""SELECT scenario_id, network_id, carrier, node, round(-sum(mw), 4) + 0.0 AS power,
    CAST(hour // 24 + 1 AS INTEGER) AS dag, CAST(hour % 24 + 1 AS INTEGER) AS uur FROM (
    SELECT f.scenario_id, network_id, f.carrier, hour, substation AS node, mw FROM (
        SELECT scenario_id, carrier, site, hour, mw FROM gas_balanced WHERE hour < {CALENDAR}
        UNION ALL SELECT c.scenario_id, c.carrier, site, CAST(h AS INTEGER), mw FROM gas_balanced c
        JOIN gas_length l ON c.scenario_id = l.scenario_id AND c.carrier = l.carrier AND c.hour = l.n - 1
        JOIN range({CALENDAR}) AS k(h) ON h >= n WHERE n < {CALENDAR}) f
    JOIN gas_listed s ON f.scenario_id = s.scenario_id AND f.carrier = s.carrier AND f.site = s.site
    UNION ALL SELECT s.scenario_id, network_id, carrier, CAST(h AS INTEGER), CASE WHEN carrier = 'methane' THEN 'BAL_M' ELSE 'BAL_H' END, 0
        FROM (SELECT DISTINCT scenario_id, network_id, carrier FROM gas_listed) s, range({CALENDAR}) AS k(h)) GROUP BY ALL""")
def e2(spark, d):
    """Balance on the slack sites, calendar and balance nodes in one call, market lengths from the market's own curves."""
    full = v.market_length(spark, d).select("scenario_id", "carrier", F.explode(F.sequence(F.lit(0), F.lit(CALENDAR - 1))).alias("hour"))
    return quality.checked_gas_input(v.gas_curve(spark, d), v.gas_site(spark, d), full, CALENDAR, v.NETWORK)[0]


def _wide(spark, d):
    """Curves of all sites as wide semicolon files, gzip, one folder per scenario, one file per block of sites in it; a column is a site's place in its block."""
    folder = scratch_path(spark, "wide")
    for scenario, width in WIDE_SITES.items():
        site = F.col("site").cast("long")
        rows = v.site_curve(spark, d).where(F.col("scenario_id") == scenario)
        rows = rows.select(F.floor(site / width).alias("block"), "hour", (site % width).cast("string").alias("place"), "mw")
        wide = curves.to_wide(rows, ["block", "hour"], "place", [str(k) for k in range(width)])
        sinks.write_csv(wide.repartition("block"), f"{folder}/{scenario}", ["block"], sort=["block", "hour"])
    return [f"{folder}/{s}/*" for s in WIDE_SITES]


def _wide_place(n):
    """Scenario (1) or block (2) of a wide file."""
    return F.regexp_extract("path", r"/([FO])/block=(\d+)/[^/]*$", n)


@query("src2_wide_files", """SELECT scenario_id, hour, site, round(mw, 4) + 0.0 AS mw FROM site_curve""")
def src2_wide(spark, d):
    cells = archives.read_wide_files(spark, _wide(spark, d)).where(F.col("mw").isNotNull())
    width = F.when(F.col("scenario_id") == "F", WIDE_SITES["F"]).otherwise(WIDE_SITES["O"])
    site = (_wide_place(2).cast("long") * width + F.col("site").cast("long")).cast("string").alias("site")
    return cells.withColumn("scenario_id", _wide_place(1)).select("scenario_id", "hour", site, "mw")


@query("o1_sorted_sink", """SELECT scenario_id, CAST(count(*) AS BIGINT) AS n, true AS in_order FROM (SELECT DISTINCT scenario_id, hour FROM site_curve) GROUP BY ALL""")
def o1(spark, d):
    """Hours come back from every file in the order in which the sink has sorted them."""
    cells = archives.wide_cells(spark, _wide(spark, d), hour=None)
    hours = cells.where(F.col("site") == "hour").select("path", "hour", F.col("value").cast("int").alias("v"))
    line = F.array_sort(F.collect_list(F.struct("hour", "v")))
    values = hours.groupBy("path").agg(F.transform(line, lambda s: s["v"]).alias("_v"))
    files = values.select(_wide_place(1).alias("scenario_id"), "_v", (F.col("_v") == F.array_sort("_v")).alias("_sorted"))
    seen = files.select("scenario_id", "_sorted", F.explode("_v").alias("_hour"))
    return seen.groupBy("scenario_id").agg(F.count_distinct("_hour").alias("n"), F.bool_and("_sorted").alias("in_order"))


@query("src3_decimal_comma", """SELECT r_name AS node, 'Sector ' || k AS sector, round((r_regionkey + k) / 8, 4) + 0.0 AS weight
    FROM region, range(3) AS s(k)""")
def src3(spark, d):
    path = scratch_path(spark, "weights")
    share = lambda k: F.regexp_replace(((F.col("r_regionkey") + k) / 8).cast("string"), r"\.", ",").alias(f"Sector {k}")
    wide = v.table(spark, d, "region").select(F.col("r_name").alias("node"), *[share(k) for k in range(3)])
    wide.coalesce(1).write.option("sep", ";").option("header", True).csv(path)
    return tables.read_weights(spark, path)


@query("src4_lookup_columns", """SELECT 'link ' || n_nationkey AS name, n_nationkey / 4 AS length_km, n_name AS from_node, 'R' || n_regionkey AS to_node FROM nation""")
def src4(spark, d):
    path = scratch_path(spark, "links")
    text = lambda c: F.col(c).cast("string")
    rows = v.table(spark, d, "nation").select(
        F.concat(F.lit("link "), text("n_nationkey")).alias("naam"), (F.col("n_nationkey") / 4).alias("lengte"), F.lit(0.5).alias("diameter"),
        F.col("n_name").alias("van"), F.concat(F.lit("R"), text("n_regionkey")).alias("naar"), F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit(3).alias("c"),
    )
    rows.coalesce(1).write.option("sep", ";").option("header", True).csv(path)
    return tables.read_link_factors(spark, path)


@query("p10_header_names", """SELECT s_suppkey % 2 AS design, 's' || s_suppkey AS site, 'N' || s_nationkey || '25' AS substation FROM supplier""")
def p10(spark, d):
    """One design's files say "substation", the other's "substation [t-1]"."""
    folder = scratch_path(spark, "sites")
    parts = []
    for design, header in ((0, "substation"), (1, "substation [t-1]")):
        rows = v.table(spark, d, "supplier").where(F.col("s_suppkey") % 2 == design).select(
            F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("asset"),
            F.concat(F.lit("N"), F.col("s_nationkey").cast("string"), F.lit("25")).alias(header),
        )
        rows.repartition("asset").write.option("sep", ";").option("header", True).csv(f"{folder}/d{design}")
        parts.append(tables.read_sites(spark, f"{folder}/d{design}", {"design": r"/d(\d)/[^/]*$"}))
    return parts[0].unionByName(parts[1]).select(F.col("design").cast("bigint").alias("design"), "site", "substation")


@query("src6_document_field", """SELECT CAST(o_orderkey AS VARCHAR) AS field, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL""")
def src6(spark, d):
    path = scratch_path(spark, "documents")
    rows = v.table(spark, d, "orders").select("o_orderkey", "o_orderstatus").repartition("o_orderkey")  # lines of many files
    rows.select(F.to_json(F.struct(F.col("o_orderkey").alias("contextScenario"), F.struct("o_orderstatus").alias("other"))).alias("value")).write.text(path)
    found = tables.read_document_field(spark, f"{path}/*.txt", "contextScenario", multi_line=False)
    return found.groupBy(F.col("contextScenario").alias("field")).agg(F.count("*").alias("n"))


@query("src9_price_files", "SELECT scenario_id, hour, round(price, 4) + 0.0 AS price FROM price_file")
def src9(spark, d):
    """Prices of all orders, a file for every ``PRICE_ROWS`` of a scenario; the hours of its files follow each other."""
    folder = scratch_path(spark, "prices")
    factors = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(f).alias("f")) for s, f in (("F", 1.0), ("O", 2.0))])).alias("_c")
    rows = v.table(spark, d, "orders").select("o_orderkey", "o_totalprice", factors)
    rows = rows.select(F.col("_c.s").alias("scenario_id"), "o_orderkey", (F.col("o_totalprice") * F.col("_c.f")).alias("Price"))
    placed = positions.number_rows(rows, SCENARIO, "o_orderkey", "_pos").withColumn("block", F.floor(F.col("_pos") / PRICE_ROWS))
    lines = placed.repartition("scenario_id", "block").sortWithinPartitions("scenario_id", "block", "_pos")
    lines = lines.select("scenario_id", "block", F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("Time"), "Price")
    lines.write.partitionBy("scenario_id", "block").option("header", True).csv(folder)
    prices = tables.read_prices(spark, f"{folder}/*/*", {"scenario_id": "/scenario_id=([FO])/", "block": r"/block=(\d+)/"})
    return prices.select("scenario_id", (F.col("block").cast("int") * PRICE_ROWS + F.col("hour")).alias("hour"), "price")


define("price_file", """SELECT s.scenario_id, CAST(row_number() OVER (PARTITION BY s.scenario_id ORDER BY o_orderkey) - 1 AS INTEGER) AS hour, o_totalprice * f AS price
    FROM orders, (VALUES ('F', 1.0::DOUBLE), ('O', 2.0::DOUBLE)) AS s(scenario_id, f)""")


@query("v15_unreadable_numbers", """SELECT CAST(n_nationkey AS INTEGER) AS hour, 'n' || (n_nationkey % 3) || 'x' AS value FROM nation WHERE n_nationkey % 5 = 0""")
def v15(spark, d):
    from hourgrid.operators import checks

    path = scratch_path(spark, "faulty")
    value = F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("n"), (F.col("n_nationkey") % 3).cast("string"), F.lit("x")))
    value = F.when(F.col("n_nationkey") % 5 == 1, F.lit("")).otherwise(F.coalesce(value, (F.col("n_nationkey") / 4).cast("string")))
    rows = v.table(spark, d, "nation").select(F.col("n_nationkey").alias("hour"), value.alias("a")).coalesce(1)
    rows.write.option("sep", ";").option("header", True).option("emptyValue", "").csv(path)
    return checks.unreadable_numbers(archives.wide_cells(spark, path), "value").select("hour", "value")
