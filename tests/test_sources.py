"""Readers and writers on files written by the test itself."""

import gzip
import io
import json
import tarfile
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hourgrid import sinks
from hourgrid.operators import export, overload, profiles, scenarios
from hourgrid.sources import archives, messages, packed, tables


def pack(path: Path, members: dict[str, str]) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w:gz") as out:
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        out.addfile(folder)
        for name, content in members.items():
            data = content.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            out.addfile(info, io.BytesIO(data))
    return str(path)


def test_site_records(spark, tmp_path):
    header = ",assetName,assetClass,carrierId,sector,allocationPower\n"
    path = pack(tmp_path / "series.tar.gz", {
        "a.csv": header + "0,Site A,EConnection,EL,x,2000000\n1,Site A,EConnection,EL,x,too,many,fields\n2,Site A,EConnection,EL,x,\n",
        "b.csv": ",other\n0,1\n",
        "c.csv": header + "0,CO2_F_1,GConnection,CO2_F,y,5\n",
    })
    raw = archives.site_records(spark, path)
    got = rows(raw, "member", "member_pos", "row_idx", "assetName", "allocationPower")
    # the broken line is skipped, an empty reading is null, a member without the columns has nulls
    assert got == [("a.csv", 0, 0, "Site A", 2e6), ("a.csv", 0, 1, "Site A", None), ("b.csv", 1, 0, None, None), ("c.csv", 2, 0, "CO2_F_1", 5.0)]
    routed = export.route(raw, ())
    assert rows(routed, "carrier", "member", "mw") == [("co2", "c.csv", 5e-6), ("electricity", "a.csv", 2.0), ("electricity", "a.csv", None)]
    assert rows(export.co2_streams(raw, ()), "stream", "assetName") == [("CO2_F", "CO2_F_1")]


def test_long_members_are_read_whole(spark, tmp_path):
    n = packed.ROWS * 2 + 5
    body = "".join(f"{i},{i}.5\n" for i in range(n))
    path = pack(tmp_path / "market.tar.gz", {"x.csv": "Time,other\n", "merit_order.csv": "Time,key (MW)\n" + body})
    got = archives.market_curves(spark, path)
    assert got.count() == n and got.agg(F.max("hour"), F.sum("mw")).first()[:] == (n - 1, sum(i + 0.5 for i in range(n)))
    assert rows(got.where("hour = 4100"), "market_key", "mw") == [("key (MW)", 4100.5)]


def test_gas_curves_and_links(spark, tmp_path):
    path = pack(tmp_path / "gas.tar.gz", {"methane.csv": ";a;b\n0;1.5;\n1;2.5;3.5\n", "hydrogen.csv": ";h\n0;9\n"})
    got = rows(archives.gas_site_curves(spark, path), "carrier", "hour", "site", "mw")
    assert got == [("hydrogen", 0, "h", 9.0), ("methane", 0, "a", 1.5), ("methane", 0, "b", None), ("methane", 1, "a", 2.5), ("methane", 1, "b", 3.5)]
    links = pack(tmp_path / "flow" / "im2_0007.tar.gz", {
        "other.csv": ";naam\n0;no\n", "faal_1.csv": ";naam;berekening;voorwaarde\n0;L1;-5;2\n1;L1;1;2\n",
        "faal_2.csv": ";naam;berekening;voorwaarde\n0;L9;1;1\n"})
    flows = archives.link_flows(spark, links)
    assert rows(flows, "member", "naam", "berekening") == [("faal_1.csv", "L1", -5.0), ("faal_1.csv", "L1", 1.0)]
    keyed = scenarios.model_and_network(flows.withColumn("folder", F.regexp_extract("path", r"([^/]+)\.tar\.gz$", 1)), "folder")
    assert rows(keyed.select("investmentModel", "networkId").distinct()) == [("im2", "0007")]


def test_many_archives_at_once(spark, tmp_path):
    for s in "abc":
        pack(tmp_path / s / "market.tar.gz", {"merit_order.csv": f"Time,k\nt,{ord(s)}\n"})
    got = archives.market_curves(spark, f"{tmp_path}/*/market.tar.gz")
    keyed = got.withColumn("scenario_id", F.regexp_extract("path", r"([^/]+)/market\.tar\.gz$", 1))
    assert rows(keyed, "scenario_id", "mw") == [("a", 97.0), ("b", 98.0), ("c", 99.0)]


def write_gz(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()))
    return str(path)


def test_wide_curves_with_keys_from_folders(spark, tmp_path):
    write_gz(tmp_path / "s1" / "2030" / "curves.csv.gz", "a;b;hour\n1.5;;0\n2.5;-1;1\n")
    path = f"{tmp_path}/*/*/curves.csv.gz"
    assert tables.header_of(spark, path) == ["a", "b", "hour"]
    got = tables.read_wide_curves(spark, path, ["a", "b"], patterns={"scenario_id": r"/([^/]+)/\d{4}/", "year": r"/(\d{4})/"})
    assert rows(got, "scenario_id", "year", "hour", "site", "mw") == [
        ("s1", "2030", 0, "a", 1.5), ("s1", "2030", 0, "b", None), ("s1", "2030", 1, "a", 2.5), ("s1", "2030", 1, "b", -1.0)]


def test_wide_files_with_columns_of_their_own(spark, tmp_path):
    write_gz(tmp_path / "s1" / "curves.csv.gz", "a;b;hour\n1.5;;0\n2.5;-1;1\n")
    write_gz(tmp_path / "s2" / "curves.csv.gz", "hour;c\n5;7\n")
    got = archives.read_wide_files(spark, f"{tmp_path}/*/curves.csv.gz")
    keyed = got.withColumn("scenario_id", F.regexp_extract("path", r"([^/]+)/curves", 1))
    assert rows(keyed, "scenario_id", "hour", "site", "mw") == [
        ("s1", 0, "a", 1.5), ("s1", 0, "b", None), ("s1", 1, "a", 2.5), ("s1", 1, "b", -1.0), ("s2", 5, "c", 7.0)]
    (tmp_path / "plain.csv").write_text("a\n1\n2\n")
    plain = archives.read_wide_files(spark, str(tmp_path / "plain.csv"), hour=None)
    assert rows(plain, "hour", "site", "mw") == [(0, "a", 1.0), (1, "a", 2.0)]


def test_lookups(spark, tmp_path):
    (tmp_path / "cat.csv").write_text("KEY;carrier;product;category;sector\nk (MW);Electricity;Demand;Flex;Other\n")
    assert rows(tables.read_categories(spark, str(tmp_path / "cat.csv"))) == [("k (MW)", "Electricity", "Demand", "Flex", "Other")]
    (tmp_path / "reg.csv").write_text(";Sector 1;Sector 2\nn1;0,33;1\nn2;0,67;..\n")
    assert rows(tables.read_weights(spark, str(tmp_path / "reg.csv"))) == [
        ("n1", "Sector 1", 0.33), ("n1", "Sector 2", 1.0), ("n2", "Sector 1", 0.67), ("n2", "Sector 2", None)]
    (tmp_path / "factors.csv").write_text("﻿Name;Length (km);Diameter (m);From;To;;;\nA1;11.5;1.0;BAL_M;S-1;;;\nA2;2;1;BAL_H;HW_001;;;\n", encoding="utf-8")
    links = tables.read_link_factors(spark, str(tmp_path / "factors.csv"))
    assert rows(links) == [("A1", 11.5, "BAL_M", "S-1"), ("A2", 2.0, "BAL_H", "HW_001")]
    assert rows(overload.split_links(links), "carrier", "name") == [("hydrogen", "A2"), ("methane", "A1")]
    (tmp_path / "plans.csv").write_text("index;2025;2030\nPlan 1;0007;0012\n")
    plans = scenarios.plan_map_long(tables.read_plan_map(spark, str(tmp_path / "plans.csv")))
    assert rows(plans) == [("Plan 1", "2025", "0007"), ("Plan 1", "2030", "0012")]
    assert rows(scenarios.plans_using_network(plans, "12")) == [("Plan 1",)]


def test_sites_and_substations(spark, tmp_path):
    a = write_gz(tmp_path / "d1" / "sites.csv.gz", "site;substation [t-1];sector;capacity\nx;N25;Industry_Food;3.5\n")
    assert rows(tables.read_sites(spark, a)) == [("x", "N25", "Industry Food", 3.5)]
    b = write_gz(tmp_path / "d1" / "msites.csv.gz", "name;node\nx;K1\ny;\n")
    assert rows(tables.read_sites(spark, b, gas=True)) == [("x", "K1"), ("y", None)]
    with pytest.raises(ValueError, match="substation"):
        tables.read_sites(spark, b)
    c = write_gz(tmp_path / "d1" / "substations.csv.gz", "n;station;capacity;trafos\n0;N25;40;2\n")
    got = tables.read_substations(spark, c, {"design": r"/([^/]+)/substations"})
    assert rows(got) == [("d1", "N25", 40.0, 2)]


def test_names_in_file_order(spark, tmp_path):
    (tmp_path / "names.csv").write_text("EIn,EOut,GIn,GOut\na,A1,m,M1\na,A2,,\nb,B1,m,M2\n")
    long = tables.read_names(spark, str(tmp_path / "names.csv"), {"electricity": ("EIn", "EOut"), "methane": ("GIn", "GOut")})
    # all carriers are named by the electricity map
    assert rows(export.latest_names(long, ()), "raw_name", "grid_name") == [("a", "A2"), ("b", "B1")]
    assert not export.same_names(long, ())
    twice = tables.read_names(spark, str(tmp_path / "names.csv"), {"electricity": ("EIn", "EOut"), "methane": ("EIn", "EOut")})
    assert export.same_names(twice, ())


def test_prices(spark, tmp_path):
    for s in ("s1", "s2"):
        (tmp_path / s).mkdir()
        (tmp_path / s / "price.csv").write_text("Time,Price\n" + "".join(f"t{i},{i}.25\n" for i in range(30)))
    prices = tables.read_prices(spark, f"{tmp_path}/*/price.csv", {"scenario_id": r"/([^/]+)/price\.csv"})
    got = rows(prices, "scenario_id", "hour", "price")
    assert got == [(s, i, i + 0.25) for s in ("s1", "s2") for i in range(30)]
    assert profiles.price_profile(prices, ("scenario_id",)).count() == 60


def test_document_field(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"contextScenario": 12345, "other": {"a": 1}}, indent=1))
    got = tables.read_document_field(spark, str(tmp_path / "c.json"), "contextScenario").collect()
    assert got[0]["contextScenario"] == "12345" and got[0]["path"].endswith("c.json")


def test_network_keeps_leading_zeros(spark, tmp_path):
    frame = spark.createDataFrame([("0001", 1), ("0012", 2)], "network_id string, bus_id bigint")
    for name in ("bus", "line", "trafo"):
        sinks.write_table(frame, f"{tmp_path}/{name}", ["network_id"])
    net = tables.read_network(spark, str(tmp_path), ["0001"])
    assert rows(net["bus"], "network_id", "bus_id") == [("0001", 1)]
    assert "PartitionFilters: [isnotnull(network_id" in net["bus"]._jdf.queryExecution().executedPlan().toString() or "network_id" in str(net["bus"].inputFiles())


def test_messages_once_and_twice_encoded(spark, tmp_path):
    record = {"scenarioId": 7, "scenarioYear": 2030, "bucketFolder": "a/b/", "someLocation": "x/y"}
    once = {"Records": [{"body": json.dumps(record)}]}
    twice = {"Records": [{"body": json.dumps({"Message": json.dumps(record)})}, {"body": "not json"}]}
    (tmp_path / "1.json").write_text(json.dumps(once, indent=2))
    (tmp_path / "2.json").write_text(json.dumps(twice))
    got = messages.read_batches(spark, str(tmp_path))
    seen = rows(got.select("scenarioId", "scenarioYear", "bucketFolder", "calculationState", F.col("fields")["someLocation"]))
    assert seen == [("7", "2030", "a/b/", None, "x/y")] * 2
    back = [json.loads(r[0]) for r in got.select(messages.encode(got)).collect()]
    assert back == [{**{k: str(v) for k, v in record.items()}}] * 2


def test_csv_sink(spark, tmp_path):
    curve = spark.createDataFrame([("s", 1, "a", 1.5), ("s", 0, "a", 2.0)], "scenario_id string, hour int, site string, mw double")
    sinks.write_csv(curve, f"{tmp_path}/out", sort=["hour"])
    file = next(Path(f"{tmp_path}/out/scenario_id=s").glob("*.csv.gz"))
    assert gzip.decompress(file.read_bytes()).decode().splitlines()[0] == "hour;site;mw"


def test_sinks_keep_other_runs(spark, tmp_path):
    run = lambda name, mw: spark.createDataFrame([(name, 0, "a", mw)], "scenario_id string, hour int, site string, mw double")
    for write, read in (
        (sinks.write_table, lambda p: spark.read.parquet(p)),
        (sinks.write_csv, lambda p: spark.read.option("sep", ";").option("header", True).schema("hour int, site string, mw double, scenario_id string").csv(p)),
    ):
        path = f"{tmp_path}/{write.__name__}"
        for name, mw in (("A", 1.0), ("B", 2.0), ("A", 3.0)):
            write(run(name, mw), path)
        assert rows(read(path), "scenario_id", "mw") == [("A", 3.0), ("B", 2.0)]


def test_the_first_member_of_the_archive_gives_the_length(spark, tmp_path):
    header = ",assetName,assetClass,carrierId,sector,allocationPower\n"
    path = pack(tmp_path / "series.tar.gz", {
        "z.csv": header + "".join(f"{i},Z,EConnection,EL,x,1000000\n" for i in range(3)),
        "a.csv": header + "0,A,EConnection,EL,x,1000000\n",
        "b.csv": header + "".join(f"{i},B,EConnection,EL,x,1000000\n" for i in range(5)),
    })
    raw = archives.site_records(spark, path)
    names = spark.createDataFrame([], "raw_name string, grid_name string, row_idx int")
    got = export.export_site_curves(raw, names, by=()).groupBy("asset").count()
    assert rows(got) == [("A", 1), ("B", 3), ("Z", 3)]
    series = export.one_row_per_carrier(export.number_hours(export.targets(raw, ()), ()))
    assert rows(export.longer_than_first(series, ()), "member", "rows_lost") == [("b.csv", 2)]
