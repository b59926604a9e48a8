from datetime import date

import pytest

from medallion.operators.windows import DayWindow, day_window

TODAY = date(2024, 3, 1)


def test_day_before_crosses_a_month():
    assert day_window("d-1", TODAY).days() == ["20240229"]


def test_from_start_day_up_to_today_inclusive():
    assert day_window("d-x", TODAY, "20240227").days() == [
        "20240227",
        "20240228",
        "20240229",
        "20240301",
    ]


def test_full_refresh_is_every_day():
    assert day_window("full-refresh", TODAY).everything
    assert day_window("full-refresh", TODAY).glob() == "[0-9]" * 8


@pytest.mark.parametrize(
    "mode, start", [("weekly", None), ("d-x", None), ("d-x", "20240302"), ("d-x", "March")]
)
def test_bad_settings_fail_at_once(mode, start):
    with pytest.raises(ValueError):
        day_window(mode, TODAY, start)


def test_windows_list_their_days():
    long = DayWindow(date(2023, 11, 20), date(2024, 2, 3))
    assert long.glob() == "{" + ",".join(long.days()) + "}" and len(long.days()) == 76
    assert DayWindow(date(2024, 1, 1), date(2024, 1, 2)).glob() == "{20240101,20240102}"


def test_predicate_keeps_the_bounds(spark):
    known = ["20240226", "20240227", "20240301", "20240302"]
    days = spark.createDataFrame([(day,) for day in known], "d string")
    kept = days.where(day_window("d-x", TODAY, "20240227").holds(days.d)).collect()
    assert [row.d for row in kept] == ["20240227", "20240301"]
