import json
import os

import pytest

from gridplume import fixtures as fx
from gridplume.operators.shaping import MissingFields
from gridplume.schemas import SOURCE_FIELDS
from gridplume.sources import landing
from datetime import date
from tests.rows import as_set, hourly, plan, reading


def land_array(root, folder, readings, name="a.json", lines=False):
    """A file as the fetch would leave it."""
    place = os.path.join(root.removeprefix("file:"), folder)
    os.makedirs(place, exist_ok=True)
    with open(os.path.join(place, name), "w") as f:
        f.write("\n".join(map(json.dumps, readings)) + "\n" if lines else json.dumps(readings, indent=1))


@pytest.mark.parametrize("fmt", ["json", "json_array"])
def test_json_landing(spark, path, fmt):
    root = path("landing")
    land_array(root, "state=TX/year=2024/month=01", [reading(), reading(grossLoad=7.5, hour=3)], lines=fmt == "json")
    land_array(root, "state=TX/year=2024/month=02", [], lines=fmt == "json")
    rows = landing.hourly_scan(spark, root, fmt, strict_fields=False)
    assert sorted((r.grossLoad, r.chunk_state, r.chunk_year, r.chunk_month, r.snapshot) for r in rows.collect()) == [
        ("10", "TX", 2024, 1, None), ("7.5", "TX", 2024, 1, None),
    ]
    files = landing.landed_files(spark, root)
    assert as_set(files.select("state", "year", "month", "snapshot")) == [("TX", 2024, 1, None), ("TX", 2024, 2, None)]


def test_parquet_and_flat_landing(spark, path):
    root = path("landing")
    hourly(spark, reading(), reading(date="2024-02-01")).write.parquet(root)
    rows = landing.hourly_scan(spark, root, "parquet", strict_fields=True)
    assert rows.count() == 2 and rows.where("chunk_year is null").count() == 2


def test_nothing_landed(spark, path):
    root = path("landing")
    assert landing.hourly_scan(spark, root).isEmpty()
    assert landing.landed_files(spark, root).isEmpty()


def test_only_completed_months(spark, path):
    root = path("landing")
    fx.land(fx.with_folders(hourly(spark, reading(), reading(date="2024-02-01"), reading(date="2024-03-01"))), root)
    rows = landing.hourly_scan(spark, root, as_of=date(2024, 3, 5))
    assert {r.chunk_month for r in rows.collect()} == {1, 2}
    assert "202402" in plan(rows).split("PartitionFilters")[1].split("\n")[0]


def test_chunks_prune_folders(spark, path):
    root = path("landing")
    fx.land(fx.with_folders(hourly(spark, reading(), reading(date="2024-02-01"), reading(stateCode="AK"))), root)
    wanted = spark.createDataFrame([("TX", 2024, 1)], "state string, year int, month int")
    rows = landing.hourly_scan(spark, root, chunks=wanted)
    assert [(r.chunk_state, r.chunk_month) for r in rows.collect()] == [("TX", 1)]
    assert "dynamicpruning" in plan(rows)


@pytest.mark.parametrize("fmt", ["json", "json_array"])
def test_missing_fields_are_found(spark, path, fmt):
    root = path("landing")
    short = {k: v for k, v in reading().items() if k != "noxMass"}
    with_null = {**reading(), "co2Mass": None}
    land_array(root, "state=TX/year=2024/month=01", [short, with_null, short], lines=fmt == "json")
    assert landing.missing_fields(spark, root, fmt).isEmpty(), "one record names it"
    land_array(root, "state=TX/year=2024/month=02", [short, short], lines=fmt == "json")
    assert [r.field for r in landing.missing_fields(spark, root, fmt).collect()] == ["noxMass"]
    with pytest.raises(MissingFields, match="noxMass"):
        landing.hourly_scan(spark, root, fmt, strict_fields=True)


def text_file(root, folder, text, name="a.json"):
    place = os.path.join(root.removeprefix("file:"), folder)
    os.makedirs(place, exist_ok=True)
    with open(os.path.join(place, name), "w") as f:
        f.write(text)


JAN = "state=TX/year=2024/month=01"
LINES = json.dumps(reading()) + "\n" + json.dumps(reading(unitId="U2")) + "\n"
BROKEN = {
    "json": [LINES[:-30] + "\n" + LINES, "<html>\n<body>503</body></html>\n", LINES + "17\n"],
    "json_array": [json.dumps([reading(), reading()])[:-1], json.dumps([reading(), reading()])[:-40], "<html>503</html>", "[" + LINES],
}


@pytest.mark.parametrize("fmt", ["json", "json_array"])
def test_records_that_cannot_be_read(spark, path, fmt):
    for text in BROKEN[fmt]:
        root = path("landing")
        text_file(root, JAN, text)
        assert any(r.corrupt for r in landing.hourly_scan(spark, root, fmt, audited=True).collect()), text
        with pytest.raises(Exception):
            landing.hourly_scan(spark, root, fmt).collect()


ARRAYS = [
    "[]", " [ ] \n", json.dumps([reading()]), json.dumps([reading(), reading(grossLoad=3)], indent=2), "\ufeff" + json.dumps([reading()]),
    json.dumps([reading(facilityName="a } b"), reading(facilityName='{"x": [1]}')]), json.dumps([reading(extra={"a": {"b": []}}), reading()]),
    json.dumps([reading(unitType=None)]), json.dumps([reading() for _ in range(300)]),
]


def test_arrays_come_apart_record_by_record(spark, path):
    """Whatever stands in the records, and wherever the files are cut for tasks."""
    root = path("landing")
    for k, text in enumerate(ARRAYS):
        text_file(root, f"state=S{k}/year=2024/month=01", text)
    rows = landing.hourly_scan(spark, root, "json_array", audited=True)
    want = sorted((f"S{k}", r["facilityName"], str(r["grossLoad"])) for k, text in enumerate(ARRAYS) for r in json.loads(text.lstrip("\ufeff")))
    assert sorted((r.chunk_state, r.facilityName, r.grossLoad) for r in rows.collect()) == want
    assert not any(r.corrupt for r in rows.collect()) and landing.missing_fields(spark, root, "json_array").isEmpty()


def test_a_large_array_is_read_by_many_tasks(spark, path, setting):
    setting("spark.sql.files.maxPartitionBytes", "64k")
    root = path("landing")
    text_file(root, JAN, json.dumps([reading(unitId=str(k)) for k in range(3000)]))
    rows = landing.hourly_scan(spark, root, "json_array", audited=True)
    assert rows.count() == 3000 and rows.select("unitId").distinct().count() == 3000
    assert rows.rdd.getNumPartitions() > 4


def test_parquet_files_without_a_field(spark, path):
    root = path("landing")
    whole, short = hourly(spark, reading()), hourly(spark, reading()).drop("so2Mass")
    whole.write.parquet(f"{root}/state=AK/year=2024/month=1")
    short.write.parquet(f"{root}/state=TX/year=2024/month=1")
    whole.write.mode("append").parquet(f"{root}/state=WY/year=2024/month=1")
    short.write.mode("append").parquet(f"{root}/state=WY/year=2024/month=1")
    assert [tuple(r) for r in landing.missing_fields(spark, root, "parquet").collect()] == [("TX", 2024, 1, "so2Mass")]
    with pytest.raises(MissingFields, match="so2Mass"):
        landing.hourly_scan(spark, root, "parquet", strict_fields=True)


def test_folders_of_some_months(spark, path):
    root = path("landing")
    for folder in ("state=TX/year=2024/month=01", "state=AK/year=2024/month=1", "state=TX/year=2024/month=10", "state=TX/year=2023/month=01"):
        land_array(root, folder, [reading()])
    found = landing.month_folders(spark, root, [(2024, 1), (2024, 2)])
    assert [f.split("/state=")[1] for f in found] == ["AK/year=2024/month=1", "TX/year=2024/month=01"]
    assert landing.landed_files(spark, root, found).count() == 2
    assert landing.landed_files(spark, root, []).isEmpty() and landing.hourly_scan(spark, root, folders=[]).isEmpty()
    assert landing.hourly_scan(spark, root, "json_array", folders=found).count() == 2


def test_unknown_format(spark, path):
    with pytest.raises(ValueError):
        landing.hourly_scan(spark, path(), "csv")


def test_fields():
    assert len(SOURCE_FIELDS) == 12


def test_footers_of_many_chunks_are_read_in_one_pass(spark, path):
    """The jobs that find missing columns are as many for five hundred chunks as for one."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    def jobs(chunks):
        root = path("landing").removeprefix("file:")
        for k in range(chunks):
            place = f"{root}/state=S{k % 50:02d}/year={2016 + k // 50}/month=1/snapshot=1"
            os.makedirs(place, exist_ok=True)
            names = [f for f in SOURCE_FIELDS if not (f == "so2Mass" and k % 5 == 0)]
            pq.write_table(pa.table({f: pa.array([None], pa.string()) for f in names}), f"{place}/a.parquet")
            if k % 10 == 0:
                # Another file of the chunk names it.
                pq.write_table(pa.table({f: pa.array(["1"], pa.string()) for f in SOURCE_FIELDS}), f"{place}/b.parquet")
        spark.sparkContext.setJobGroup(root, "footers")
        missing = landing.missing_fields(spark, f"file:{root}", "parquet").collect()
        ran = len(spark.sparkContext.statusTracker().getJobIdsForGroup(root))
        spark.sparkContext._jsc.clearJobGroup()
        return missing, ran

    few, ran_few = jobs(1)
    many, ran_many = jobs(500)
    assert few == [] and {r.field for r in many} == {"so2Mass"} and len(many) == 50
    assert ran_many <= ran_few + 1


def test_footers_of_another_store_come_through_sparks_reader(spark, path):
    from pyspark.sql import functions as F

    root = path("landing")
    hourly(spark, reading()).drop("noxMass").write.parquet(f"{root}/state=TX/year=2024/month=1")
    files = landing.landed_files(spark, root)
    # The same files under a name that the tasks' own file system does not know.
    viewed = files.withColumn("path", F.regexp_replace("path", "^file:/+", "FILE:///"))
    assert not viewed.where("path like 'file:%'").count()
    names = landing._named_columns(spark, viewed.withColumn("path", F.regexp_replace("path", "^FILE:", "file:")))
    assert "noxMass" not in names.first()["keys"]
    content = spark.read.format("binaryFile").load(root).select("state", "year", "month", "content")
    found = content.mapInArrow(landing._footers, "state string, year int, month int, keys array<string>").first()
    assert "coMass" not in found["keys"] and "noxMass" not in found["keys"] and "co2Mass" in found["keys"]


def test_doubtful_arrays_are_told_apart_by_a_join(spark, path):
    root = path("landing")
    for k in range(30):
        land_array(root, f"state=S{k:02d}/year=2024/month=1/snapshot=1", [reading(stateCode=f"S{k:02d}", unitId="a}b" if k % 3 == 0 else "U1")])
    text_file(root, "state=TX/year=2024/month=1/snapshot=1", "[{\"stateCode\": \"TX\"")
    rows = landing.hourly_scan(spark, root, "json_array", audited=True)
    found = sorted((r.chunk_state, r.unitId, r.corrupt) for r in rows.collect())
    assert found == sorted([(f"S{k:02d}", "a}b" if k % 3 == 0 else "U1", False) for k in range(30)] + [("TX", None, True)])
    assert "S00" not in plan(rows), "no list of files in the plan"
