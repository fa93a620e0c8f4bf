"""Files that people write."""

import pytest
from conftest import rows

from usageledger.sources.tables import MalformedRows, access_map_csv, access_map_rows, well_formed_access_map

GOOD = "account,role,warehouse,database\nann,,WH_.*,DB_1\n,R1,,\"DB_1,2\"\n\n,R2,\"say \"\"x\"\"\",D\n"


def file_of(tmp_path, text):
    path = tmp_path / "map.csv"
    path.write_text(text)
    return str(path)


def test_a_well_formed_file(spark, tmp_path):
    path = file_of(tmp_path, GOOD.replace('""x""', "x"))
    good, bad = access_map_rows(spark, path)
    assert bad.count() == 0 and rows(good) == rows(well_formed_access_map(spark, path)) == rows(access_map_csv(spark, path))
    assert ("ann", None, "WH_.*", "DB_1") in rows(good) and (None, "R1", None, "DB_1,2") in rows(good)


def test_bad_rows_are_set_apart_and_refuse_the_whole(spark, tmp_path):
    lines = ["short,row", "a,b,c,d,e", '"not closed,R,W,D', "whole,R,W,D"]
    path = file_of(tmp_path, GOOD.replace('""x""', "x") + "\n".join(lines) + "\n")
    good, bad = access_map_rows(spark, path)
    assert {r[0] for r in rows(bad)} == set(lines[:3])
    assert good.count() == 4 and ("whole", "R", "W", "D") in rows(good)
    with pytest.raises(MalformedRows, match="3 rows"):
        well_formed_access_map(spark, path)


def test_an_empty_file(spark, tmp_path):
    good, bad = access_map_rows(spark, file_of(tmp_path, ""))
    assert good.count() == bad.count() == 0
