import datetime as dt

import pytest

from segkit.sources import csv_io
from segkit.sources.tables import MissingInputError

ROWS = {
    "whole": ["1", "-2", "+3", "", "9007199254740993"],
    "huge": ["1", "99999999999999999999", "2", "3", "4"],
    "decimal": ["1.5", "2", ".5", "-3e2", ""],
    "day": ["2024-02-29", "1999-12-31", "", "2000-01-01", "2001-01-01"],
    "no_day": ["2024-02-30", "1999-12-31", "", "2000-01-01", "2001-01-01"],
    "moment": ["2024-02-29 10:00:00", "2024-02-29T10:00:01", "", "1999-01-01 00:00:00.5", "2000-01-01 00:00:00"],
    "both": ["2024-02-29", "2024-02-29 10:00:01", "", "1999-01-01", "2000-01-01"],
    "mixed": ["1", "x", "2024-01-01", "", "true"],
    "flag": ["true", "False", "", "TRUE", "false"],
    "empty": ["", "", "", "", ""],
    "a b": ["1", "2", "3", "4", "5"],
}
WANT = {"whole": "bigint", "huge": "double", "decimal": "double", "day": "date", "no_day": "string", "moment": "timestamp", "both": "timestamp", "mixed": "string",
        "flag": "boolean", "empty": "string", "a b": "bigint"}


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_types_of_all_values(spark, tmp_path, parts):
    rows = spark.createDataFrame(list(zip(*ROWS.values())), ", ".join(f"`{c}` string" for c in ROWS)).repartition(parts)
    path = csv_io.write_csv(rows, str(tmp_path / "t"))
    out = csv_io.read_csv_inferred(spark, path)
    assert dict(out.dtypes) == WANT
    got = out.collect()
    assert sorted(r["whole"] for r in got if r["whole"] is not None) == [-2, 1, 3, 9007199254740993]
    assert sorted(r["decimal"] for r in got if r["decimal"] is not None) == [-300.0, 0.5, 1.5, 2.0]
    assert sum(r["day"] is None for r in got) == 1 and dt.date(2024, 2, 29) in {r["day"] for r in got}
    assert sum(r["flag"] is True for r in got) == 2 and all(r["empty"] is None for r in got)


def test_the_narrowest_type_of_a_header_alone_is_text(spark, tmp_path):
    path = csv_io.write_csv(spark.createDataFrame([("1", "x")], "a string, b string").limit(0).coalesce(1), str(tmp_path / "t"))
    assert csv_io.inferred_schema(spark.createDataFrame([], "a string, b string")).simpleString() == "struct<a:string,b:string>"
    assert path
    with pytest.raises(MissingInputError):
        csv_io.read_csv_inferred(spark, str(tmp_path / "none"))
