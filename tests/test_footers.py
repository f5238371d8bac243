import pytest

from helpers import rows
from tidemark.sources.footers import data_files, plain_path, split_readable, summarise_footers
from tidemark.sources.parquet import scan_parquet


def save(spark, path, values, ddl="k int, v string", mode="append"):
    spark.createDataFrame(values, ddl).coalesce(1).write.mode(mode).parquet(str(path))
    return str(path)


def damage(path, keep=0):
    """The file cut off, or overwritten where nothing is kept."""
    content = path.read_bytes()
    path.write_bytes(content[: int(len(content) * keep)] or b"junk" * 50)
    for checksum in path.parent.glob(f".{path.name}.crc"):
        checksum.unlink()


@pytest.mark.parametrize("in_tasks", [True, False])
def test_damaged_files_are_found(spark, tmp_path, in_tasks):
    for k in range(4):
        save(spark, tmp_path / "a b%", [(k, "x")])
    files = sorted((tmp_path / "a b%").glob("part*"))
    damage(files[0])
    damage(files[2], keep=0.7)
    readable, broken = split_readable(spark, [str(tmp_path / "a b%")], in_tasks)
    assert sorted(map(plain_path, readable)) == sorted(str(f) for f in (files[1], files[3]))
    assert {plain_path(p) for p in broken} == {str(files[0]), str(files[2])} and all(broken.values())
    assert spark.read.schema("k int").parquet(*readable).count() == 2
    with pytest.raises(ValueError, match="2 files cannot be read"):
        scan_parquet(spark, [str(tmp_path / "a b%")])


def test_mixed_files_inside_a_directory_are_told_apart(spark, tmp_path):
    mixed = save(spark, tmp_path / "mixed", [(1, "x")])
    save(spark, tmp_path / "mixed", [(2,)], "k int")
    with pytest.raises(ValueError, match="lacks the columns"):
        # Whichever file comes first by name, one of the two orders has a file that lacks the column.
        first = save(spark, tmp_path / "first", [(0, "w")])
        scan_parquet(spark, [first, mixed]).collect()
    wider = save(spark, tmp_path / "wider", [(3, 5)], "k int, n int")
    save(spark, tmp_path / "wider", [(4, 2**40)], "k int, n bigint")
    with pytest.raises(Exception):  # the first file's type holds, and one value is too large for it
        scan_parquet(spark, [save(spark, tmp_path / "int", [(0, 1)], "k int, n int"), wider]).collect()
    found = scan_parquet(spark, [save(spark, tmp_path / "long", [(0, 1)], "k int, n bigint"), wider])
    assert rows(found) == [(0, 1), (3, 5), (4, 2**40)]


def test_partition_columns_of_mixed_files_stay(spark, tmp_path):
    root = tmp_path / "by_day"
    save(spark, root / "day=1", [(1, 1)], "k int, n int")
    save(spark, root / "day=2", [(2, 2)], "k int, n bigint")
    found = scan_parquet(spark, [str(root)])
    assert sorted(found.columns) == ["day", "k", "n"] and rows(found.select("k", "n", "day")) == [(1, 1, 1), (2, 2, 2)]


def test_many_paths_cost_one_job(spark, tmp_path):
    import pyarrow
    import pyarrow.parquet

    paths = []
    for k in range(300):
        pyarrow.parquet.write_table(pyarrow.table({"k": [k]}), tmp_path / f"{k:04}.parquet")
        paths.append(str(tmp_path / f"{k:04}.parquet"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "")
    try:
        files = data_files(spark, paths)
        before = len(tracker.getJobIdsForGroup("footers"))
        found = summarise_footers(spark, files)
        # Adaptive execution counts each stage of the one query as a job.
        assert len(tracker.getJobIdsForGroup("footers")) - before <= 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(files) == 300 and len(found.examples) == 1 and found.broken == {}
    assert scan_parquet(spark, paths).count() == 300
