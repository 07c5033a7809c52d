"""Archives and wide node files: read back by the readers, one file per run, killed attempts never read."""

import gzip
import io
import tarfile
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_skew import no_broadcast  # noqa: F401  (a fixture)

from hourgrid.sinks import packed
from hourgrid.sources import archives
from hourgrid.sources import packed as source

BY = ("scenario_id", "year")
CURVE = "scenario_id string, year int, carrier string, hour int, site string, mw double"


def curves(spark, *more):
    given = [
        ("s1", 2030, "methane", h, s, float(h) + k / 4) for h in range(30) for k, s in enumerate(("b", "a", "c;d", 'e"f'))
    ] + [("s1", 2030, "hydrogen", h, "h", -1e-5 * h) for h in range(0, 20, 3)] + [("s 2/x", 2040, "methane", 0, "é", 1e12), ("s 2/x", 2040, "methane", 1, "z", None)]
    return spark.createDataFrame([*given, *more], CURVE).repartition(7)


def back(spark, manifest):
    paths = [r.path for r in manifest.select("path").collect()]
    return archives.gas_site_curves(spark, paths)


def test_archives_are_read_back(spark, tmp_path):
    given = curves(spark)
    manifest = packed.write_archives(given, str(tmp_path), BY)
    assert rows(manifest, "run.scenario_id", "run.year", "members", "n_lines", "n_columns") == [("s 2/x", "2040", 1, 2, 2), ("s1", "2030", 2, 37, 4)]
    # cells that no row fills are empty
    got = back(spark, manifest).where("mw IS NOT NULL")
    want = given.where("mw IS NOT NULL").select("carrier", "hour", "site", "mw")
    # a member's hours are counted by its lines
    place = {h: k for k, h in enumerate(range(0, 20, 3))}
    assert rows(got, "carrier", "hour", "site", "mw") == sorted((c, place[h] if c == "hydrogen" else h, s, v) for c, h, s, v in rows(want))


def test_members_are_as_long_as_said(spark, tmp_path):
    path = packed.write_archives(curves(spark), str(tmp_path), BY).where("run.year = '2030'").first()["path"]
    with tarfile.open(path) as archive:
        texts = {m.name: archive.extractfile(m).read().decode() for m in archive}
    assert list(texts) == ["hydrogen.csv", "methane.csv"]
    assert texts["methane.csv"].splitlines()[:2] == [';a;b;"c;d";"e""f"', "0;0.25;0.0;0.5;0.75"]
    assert len(texts["methane.csv"].splitlines()) == 31


def test_a_wrong_size_is_an_error():
    head = packed.Line((("s", "1"),), 0, "m", ["a"], 4, None, None)
    line = packed.Line((("s", "1"),), 0, "m", None, None, 0, [("a", "1")])
    assert packed._archive(io.BytesIO(), iter([head, line]), ";") == (1, 1, 1)
    with pytest.raises(OSError, match="unexpected end of data"):
        packed._archive(io.BytesIO(), iter([head._replace(size=9), line]), ";")
    with pytest.raises(ValueError, match="longer than"):
        packed._archive(io.BytesIO(), iter([head._replace(size=3), line]), ";")


def test_killed_attempts_and_older_writes_are_never_read(spark, tmp_path):
    first = packed.write_archives(curves(spark), str(tmp_path), BY)
    old = {tuple(r.run): r.path for r in first.collect()}
    # an attempt that was killed leaves half a file
    Path(f"{tmp_path}/scenario_id=s1/year=2030/series-99-dead.tar.gz").write_bytes(Path(old["s1", "2030"]).read_bytes()[:100])
    new = spark.createDataFrame([("s1", 2030, "methane", 0, "n", 7.0)], CURVE)
    packed.write_archives(new, str(tmp_path), BY)
    now = packed.committed(spark, str(tmp_path))
    assert len(list(tmp_path.rglob("*.tar.gz"))) == 4
    got = {tuple(r.run): r.path for r in now.collect()}
    assert got["s 2/x", "2040"] == old["s 2/x", "2040"] and got["s1", "2030"] != old["s1", "2030"] and len(got) == 2
    assert rows(back(spark, now.where("run.scenario_id = 's1'")), "site", "mw") == [("n", 7.0)]


def test_a_failed_write_leaves_the_old_one(spark, tmp_path):
    packed.write_archives(curves(spark), str(tmp_path), BY)
    before = rows(packed.committed(spark, str(tmp_path)), "path")
    twice = curves(spark, ("s1", 2030, "methane", 3, "a", 1.0))
    with pytest.raises(Exception, match="has a node twice"):
        packed.write_archives(twice, str(tmp_path), BY)
    assert rows(packed.committed(spark, str(tmp_path)), "path") == before


def test_each_run_has_its_own_header(spark, tmp_path):
    flows = [("n1", h, f"N{k}", h + k / 8) for h in range(40) for k in range(5)] + [("n2", h, f"M{k}", -float(h)) for h in range(3) for k in range(2)]
    given = spark.createDataFrame(flows, "network_id string, hour int, node string, mw double").repartition(5)
    manifest = packed.write_wide_files(given, str(tmp_path), ["network_id"])
    assert rows(manifest, "run.network_id", "tile", "n_lines", "n_columns") == [("n1", 0, 40, 5), ("n2", 0, 3, 2)]
    paths = {r.run.network_id: r.path for r in manifest.collect()}
    text = gzip.decompress(Path(paths["n2"]).read_bytes()).decode()
    assert text == "hour;M0;M1\n0;-0.0;-0.0\n1;-1.0;-1.0\n2;-2.0;-2.0\n"
    cells = archives.read_wide_files(spark, list(paths.values())).withColumn("network_id", F.regexp_extract("path", "network_id=([^/]+)", 1))
    assert rows(cells, "network_id", "hour", "site", "mw") == sorted(flows)


def test_wide_files_are_tiled(spark, tmp_path):
    flows = [("n", h, f"N{k:03}", float(h * k)) for h in range(4) for k in range(50) if (h + k) % 3]
    given = spark.createDataFrame(flows, "network_id string, hour int, node string, mw double")
    manifest = packed.write_wide_files(given, str(tmp_path), ["network_id"], tile=20)
    found = manifest.collect()
    assert len(found) == 3 and sum(r.n_columns for r in found) == 50
    cells = archives.read_wide_files(spark, [r.path for r in found]).where("mw IS NOT NULL")
    assert rows(cells, "hour", "site", "mw") == sorted(f[1:] for f in flows)


def test_edges(spark, tmp_path):
    none = packed.write_archives(curves(spark).limit(0), f"{tmp_path}/none", BY)
    assert none.count() == 0
    odd = spark.createDataFrame([("methane", None, "a", 1.0), ("methane", 1, None, 1.0), ("methane", 2, "a", 1.0)], "carrier string, hour int, site string, mw double")
    manifest = packed.write_archives(odd, f"{tmp_path}/one", ())
    assert rows(manifest, "members", "n_lines") == [(1, 1)]
    assert rows(back(spark, manifest), "site", "mw") == [("a", 1.0)]


def test_the_rows_of_a_tiled_run_go_to_many_tasks(spark, tmp_path, no_broadcast, monkeypatch):  # noqa: F811
    hours = spark.range(200).select(F.lit("s").alias("scenario_id"), F.col("id").cast("int").alias("hour"))
    given = hours.select("*", F.explode(F.array(*[F.lit(f"n{k}") for k in range(10)])).alias("node")).withColumn("mw", F.col("hour") * 0.5)
    join, seen = packed.sliced_join, []
    monkeypatch.setattr(packed, "sliced_join", lambda *args: seen.append(join(*args)) or seen[-1])
    manifest = packed.write_wide_files(given, str(tmp_path), ["scenario_id"], tile=4)
    (tiled,) = seen
    per_task = [r["count"] for r in tiled.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 2000 and max(per_task) < 0.4 * sum(per_task)
    paths = [r.path for r in manifest.select("path").collect()]
    got = archives.read_wide_files(spark, paths).where(F.col("mw").isNotNull())
    assert len(paths) > 1 and rows(got, "hour", "site", "mw") == rows(given, "hour", "node", "mw")


def test_the_lines_of_an_archive_are_made_in_many_tasks(spark, tmp_path, no_broadcast, monkeypatch):  # noqa: F811
    monkeypatch.setattr(packed, "PART", 300, raising=False)
    hours = spark.range(400).select(F.lit("s").alias("scenario_id"), F.lit("methane").alias("carrier"), F.col("id").cast("int").alias("hour"))
    given = hours.select("*", F.explode(F.array(*[F.lit(f"n{k}") for k in range(10)])).alias("site")).withColumn("mw", F.col("hour") * 0.5)
    more = given.where("hour % 7 = 0 AND site < 'n3'").withColumn("carrier", F.lit("hydrogen"))
    given = given.unionByName(more)
    lines = packed._lines(given, ["scenario_id"], F.col("carrier"), "hour", "site", "mw", ";", None)
    per_task = [r["count"] for r in lines.where("hour IS NOT NULL").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 458 and max(per_task) < 0.5 * sum(per_task)
    manifest = packed.write_archives(given, str(tmp_path), ["scenario_id"])
    assert rows(manifest, "members", "n_lines", "n_columns") == [(2, 458, 10)]
    (path,) = [r.path for r in manifest.select("path").collect()]
    plain = gzip.decompress(Path(path).read_bytes())  # its checksum holds
    with tarfile.open(fileobj=io.BytesIO(plain)) as archive:
        texts = {m.name: archive.extractfile(m).read().decode() for m in archive}
    assert texts["methane.csv"] == "".join([";" + ";".join(f"n{k}" for k in range(10)) + "\n", *[";".join([str(h), *[str(h / 2)] * 10]) + "\n" for h in range(400)]])
    assert texts["hydrogen.csv"] == "".join([";n0;n1;n2\n", *[f"{h};{h / 2};{h / 2};{h / 2}\n" for h in range(0, 400, 7)]])


@pytest.fixture
def in_parts(spark, tmp_path, monkeypatch):
    """The manifest of archives in many parts."""
    monkeypatch.setattr(packed, "PART", 100)
    return packed.write_archives(curves(spark, ("s1", 2030, "methane", 400, "new\nline", 2.5)), str(tmp_path), BY)


PLACE = ["member", "member_pos", "row_idx", "column", "value"]


def test_an_archive_is_read_in_parts_by_many_tasks(spark, in_parts):
    paths = [r.path for r in in_parts.collect()]
    n = sum(len(r.parts) for r in in_parts.collect())
    for options in ({}, {"label": False}, {"member": "hyd"}, {"drop": ["a"]}, {"missing": False}, {"keep_label": True}, {"keep_label": True, "missing": False, "drop": ["b"]}):
        read = lambda path: archives.text_cells(spark, path, sep=";", **options).withColumn("path", F.regexp_extract("path", "([^/]+)$", 1))  # noqa: E731, B023
        cells = read(in_parts)
        assert rows(cells) == rows(read(paths)) != []
        assert cells.rdd.getNumPartitions() == n > 5
    per_task = [r["count"] for r in archives.text_cells(spark, in_parts, sep=";").groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) < 0.5 * sum(per_task)


def test_a_label_and_what_is_missing(spark, in_parts):
    cells = archives.read_cells(spark, in_parts.where("run.scenario_id = 's1'"), sep=";", keep_label=True, missing=False)
    assert [c for c, _ in cells.dtypes] == ["path", *PLACE, "label"]
    want = curves(spark, ("s1", 2030, "methane", 400, "new\nline", 2.5)).where("scenario_id = 's1'")
    got = cells.select(F.regexp_replace("member", ".csv$", "").alias("carrier"), F.col("label").cast("int").alias("hour"), "column", "value")
    assert rows(got) == rows(want.select("carrier", "hour", "site", "mw"))


def test_a_manifest_without_parts_is_read_whole(spark, tmp_path, in_parts):
    whole = in_parts.drop("parts")
    whole.write.parquet(f"{tmp_path}/older/_manifest")
    in_parts.where("run.scenario_id = 's1'").write.mode("append").parquet(f"{tmp_path}/older/_manifest")
    found = packed.committed(spark, f"{tmp_path}/older")
    assert rows(archives.text_cells(spark, found, sep=";").select(PLACE).distinct()) == rows(archives.text_cells(spark, in_parts, sep=";").select(PLACE))
    assert {r.parts is None for r in found.collect()} == {True, False}
    assert archives.text_cells(spark, in_parts.limit(0), sep=";").count() == 0
    with pytest.raises(ValueError, match="where they lie"):
        archives.text_cells(spark, in_parts, sep=";", loaded=True)


def test_a_part_of_another_size_is_an_error(in_parts):
    found = in_parts.where("run.scenario_id = 's1'").first()
    part = found.parts[-1].asDict()
    cut = source.Cut(";", True, False, ())
    assert sum(b.num_rows for b in source.part_cells(found.path, part, cut)) > 0
    with pytest.raises(tarfile.ReadError, match="unexpected end of data"):
        list(source.part_cells(found.path, part | {"size": part["size"] + (1 << 20)}, cut))


def test_nodes_are_gathered_by_many_tasks(spark):
    """Nodes are made distinct by member and node, not in one set a member in one task."""
    lines = packed._lines(curves(spark), ["scenario_id"], F.col("carrier"), "hour", "site", "mw", ";", None)
    assert "collect_set" not in lines._jdf.queryExecution().optimizedPlan().toString()
