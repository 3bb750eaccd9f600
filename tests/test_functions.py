"""Golden values of the label and number functions."""

import pytest
from pyspark.sql import functions as F

from tsubo.functions import labels, numbers, stations


def applied(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in rows.select("i", function(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


CASES = [
    (numbers.lenient_double, {"10,000": 10.0, " 3.5x": 3.5, "": 0.0, "1e3x": 1000.0, "-": 0.0, None: None, ".5": 0.5, "NaN": 0.0}),
    (numbers.lenient_bigint, {"1.7": 1, "abc": 0, "１２": 0, " -4x": -4, None: None, "9" * 25: 2**63 - 1, "-" + "9" * 25: -(2**63)}),
    (numbers.man_yen, {"8.3万円": 83000.0, "-": 0.0, None: None}),
    (numbers.yen, {"5000円": 5000.0, "-": 0.0, "0円": 0.0, None: None}),
    (lambda c: numbers.zero_to_null(numbers.yen(c)), {"5000円": 5000.0, "-": None, "0円": None, None: None}),
    (numbers.square_metres, {"25.5m2": 25.5, None: None}),
    (labels.floor_plan, {"ワンルーム": "1R", "1K": "1K", None: None}),
    (labels.floor_label, {"3階": "3", "B1-2階": "B1-2", "階階": "", "-": "-"}),
    (labels.building_age, {"新築": 0, "築99年以上": 99, "築12年": 12, None: None, "築?年": 0}),
    (labels.building_size_label, {"平屋": "1", "3階建": "3", "地下1地上3階建": "地下1地上3", "2建階": "2", None: None}),
    (labels.building_size_total, {"地下1地上3": 4, "3": 3, "": 0, "なし": 0, "地上１２": 12, None: None}),
    (
        labels.floor_list,
        {
            "3": [3], "3-5": [3, 4, 5], "B1": [-1], "b1": [-1], "B1-2": [-1, 0, 1, 2], "-": None, "": None, "3-": None,
            "5-3": [], "1-2-3": [1, 2], "M2": None, "B2-B1": None, None: None, "３": [3], "1-99999999999": None,
        },
    ),
]


@pytest.mark.parametrize("function, golden", CASES)
def test_golden(spark, function, golden):
    assert applied(spark, function, list(golden)) == list(golden.values())


def test_ground_floor(spark):
    assert applied(spark, labels.ground_floor_to_first, [0, -1, 4, None], "bigint") == [1, -1, 4, None]


STATIONS = [
    (["A線/甲駅 歩5分", "B線/乙駅 歩8分"], ("甲駅", 5, 6.5), ("甲駅", 5, 6.5)),
    (["A線/甲駅 歩5分", "B線/乙駅 歩5分"], ("甲駅", 5, 5.0), ("甲駅", 5, 5.0)),
    (["A線/甲駅 バス10分 歩3分"], ("甲駅 バス10分", 10, 10.0), ("甲駅 バス10分", 3, 3.0)),
    (["A線/甲駅 車3分", "B線/乙駅 歩7分", "C線/丙駅 歩9分"], ("乙駅", 3, 19 / 3), ("乙駅", 7, 8.0)),
    (["A線/甲駅 車12分", "B線/乙駅 歩7分"], (None, 7, 9.5), ("乙駅", 7, 7.0)),
    (["A線/甲駅　歩5分", ""], ("甲駅", 5, 5.0), ("甲駅", 5, 5.0)),
    (["not stated"], (None, None, None), (None, None, None)),
    ([], (None, None, None), (None, None, None)),
    (None, (None, None, None), (None, None, None)),
]


@pytest.mark.parametrize("strict", [False, True])
def test_stations(spark, strict):
    rows = spark.createDataFrame([(i, blocks) for i, (blocks, *_) in enumerate(STATIONS)], "i INT, b ARRAY<STRING>")
    found = stations.summarize(F.col("b"), strict=strict)
    got = rows.select("i", *(c.alias(n) for n, c in found._asdict().items())).orderBy("i").collect()
    for row, (blocks, loose, paired) in zip(got, STATIONS, strict=True):
        assert tuple(row)[2:] == pytest.approx(paired if strict else loose), blocks
        assert row["stations"] == (",".join(blocks) if blocks else None)


def test_labels_beyond_bigint_do_not_fail(spark):
    from pyspark.sql import functions as F

    from tsubo.functions import labels
    from tsubo.operators import cleaning

    big = "9223372036854775807"
    sizes = spark.createDataFrame([(f"{big}と1",), ("地下1地上3",), ("9" * 30,)], "t STRING")
    assert [r[0] for r in sizes.select(labels.building_size_total(F.col("t"))).collect()] == [None, 4, None]
    floors = spark.createDataFrame([(big,), ("2",), (f"{big}-{big}",)], "floor STRING")
    assert sorted(r[0] for r in cleaning.explode_floors(floors).collect()) == [2, int(big), int(big)]
