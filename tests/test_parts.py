import uuid

import pytest

from bundlescope import schemas
from bundlescope.operators import merging
from bundlescope.sources import parts

NAMES = schemas.MASTER_LIST.names


def row(bundle, name="n", group="Bookworm", index="1", **other):
    values = dict.fromkeys(NAMES, "") | {
        "bundle": bundle, "app_name": name, "segment_grp": group, "segment_grp_1": group, "segment_index": index, "ifa_cnt": 1.0,
    } | other
    return tuple(values[n] for n in NAMES)


@pytest.fixture
def table(spark):
    name = f"parts_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def listed(spark, rows):
    return spark.createDataFrame(rows, schemas.MASTER_LIST)


def same(a, b):
    assert a.dtypes == b.dtypes
    assert sorted((tuple(r) for r in a.collect()), key=repr) == sorted((tuple(r) for r in b.collect()), key=repr)


def files_of(spark, table):
    found = {}
    for path in spark.table(table).inputFiles():
        found.setdefault(path.split("/part=")[1].split("/")[0], set()).add(path)
    return found


def test_fold_equals_merge_and_leaves_other_parts_alone(spark, table, tmp_path):
    old = listed(spark, [row(f"old{n}", f"bank {n}", "Corporate Professional", str(n % 3)) for n in range(60)])
    new = listed(
        spark,
        [row("new1", "b"), row("new1", "a"), row("old3", "changed"), row("", "blank"), row(None, "none")]
        + [row("old5", "again", "Corporate Professional")],
    )
    parts.create_parts(old, table, str(tmp_path), "1", parts=16)
    same(parts.read_parts(spark, table), old)
    before = files_of(spark, table)
    changed = parts.fold(new, table, str(tmp_path), "2", refine=False)
    same(parts.read_parts(spark, table), merging.merge_lists(old, new))
    after = files_of(spark, table)
    assert len(changed) == 1
    assert {p for p in after if after[p] != before.get(p)} == set(map(str, changed))
    assert all("version=2" in path for path in after[str(changed[0])])


def test_refined_fold_and_repeated_folds(spark, table, tmp_path):
    old = merging.clean_master_list(listed(spark, [row(f"a{n}") for n in range(20)]), listed(spark, []))
    new = listed(spark, [row(f"b{n}", "bitcoin bank", "Corporate Professional", None) for n in range(5)])
    parts.create_parts(old, table, str(tmp_path), "1", parts=4)
    assert parts.fold(new, table, str(tmp_path), "2")
    same(parts.read_parts(spark, table), merging.clean_master_list(old, new))
    assert parts.fold(new, table, str(tmp_path), "3") == []
    more = listed(spark, [row("c", "yoga", "Health Junkie & Fitness Junkie")])
    whole = merging.clean_master_list(parts.read_parts(spark, table), more).collect()
    parts.fold(more, table, str(tmp_path), "4")
    same(parts.read_parts(spark, table), listed(spark, whole))


def test_empty_lists(spark, table, tmp_path):
    parts.create_parts(listed(spark, []), table, str(tmp_path), "1", parts=3)
    assert parts.read_parts(spark, table).count() == 0
    assert parts.fold(listed(spark, []), table, str(tmp_path), "2") == []
    assert len(parts.fold(listed(spark, [row("a")]), table, str(tmp_path), "3")) == 1
    assert [r.bundle for r in parts.read_parts(spark, table).collect()] == ["a"]


def test_a_version_is_written_once_and_columns_must_match(spark, table, tmp_path):
    parts.create_parts(listed(spark, [row("a")]), table, str(tmp_path), "1", parts=2)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        parts.fold(listed(spark, [row("b")]), table, str(tmp_path), "1")
    with pytest.raises(ValueError, match="differ"):
        parts.fold(listed(spark, [row("b")]).selectExpr("* except (ifa_cnt)", "'1' as ifa_cnt"), table, str(tmp_path), "2")
    assert [r.bundle for r in parts.read_parts(spark, table).collect()] == ["a"]
