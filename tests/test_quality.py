from __future__ import annotations

import json
import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from medallion import schema
from medallion.functions.dates import (
    completed_years,
    fractional_years,
    latest_birth,
    months_apart,
    reference_date,
)
from medallion.functions.phones import null_unless
from medallion.plans import report
from medallion.quality import engine, rules
from medallion.schema import DATE, LONG, MONEY, TEXT, TIME, struct
from tests.conftest import final_plan, tuples

AS_OF = date(2024, 6, 15)


def ids(found):
    return sorted(r.client_id for r in found.select("client_id").collect())


def column(spark, name, kind, values):
    return spark.createDataFrame(list(enumerate(values)), struct(client_id=LONG, **{name: kind}))


# The null rule: some values null, all of them null, a column that is not there.

ROOMS = [(7, "north", 3.5), (8, None, 1.0), (9, "south", None), (10, None, None)]
ROOM_COLUMNS = ["cod_cliente", "side", "height"]


def null_check(df, columns):
    return engine.run(df, [rules.required(columns)], key="cod_cliente")


def test_rows_with_a_null_under_original_names(spark):
    df = spark.createDataFrame(ROOMS, ROOM_COLUMNS)
    found = schema.to_original(null_check(df, ["height", "side"])).collect()
    assert {r.cod_cliente: json.loads(r.rule_params)["null"] for r in found} == {
        8: ["side"],
        9: ["height"],
        10: ["height", "side"],
    }
    assert len(found) == 3
    first = found[0]
    assert (first.data_quality_offensor_cat, first.analyzed_column) == ("nulls_required", "height,side")
    assert first.offensor is None and first.created_at is not None


def test_a_column_of_nulls_alone(spark):
    df = spark.range(5).select(F.col("id").alias("cod_cliente"), F.lit(None).cast("date").alias("since"))
    found = null_check(df, ["since"])
    assert sorted(r.client_id for r in found.collect()) == [0, 1, 2, 3, 4]
    assert null_check(df, ["cod_cliente"]).count() == 0


def test_a_column_that_is_not_there(spark):
    df = spark.createDataFrame(ROOMS, ROOM_COLUMNS)
    with pytest.raises(AnalysisException):
        null_check(df, ["side", "depth"]).count()



def test_no_required_columns_no_offenders(spark):
    df = spark.createDataFrame(ROOMS, ROOM_COLUMNS)
    assert null_check(df, []).count() == 0


# Other row rules.


def test_category(spark):
    df = column(spark, "person_type", TEXT, ["PF", "PJ", "XX", "pf", "", None])
    assert ids(engine.check_rows(df, [rules.category("person_type", ("PF", "PJ"))])) == [2, 3, 4]
    assert ids(engine.check_rows(df, [rules.category("person_type", ())])) == [0, 1, 2, 3, 4, 5]


def test_negative(spark):
    values = [Decimal("-0.01"), Decimal(0), Decimal("5"), None, Decimal("-99999999.99")]
    found = engine.check_rows(column(spark, "income", MONEY, values), [rules.negative()])
    assert tuples(found, "client_id", "offender") == [(0, "-0.01"), (4, "-99999999.99")]


def test_future_birth_and_age_zero(spark):
    births = [date(2024, 6, 14), AS_OF, date(2024, 6, 16), None, date(2030, 1, 1)]
    df = column(spark, "birth_date", DATE, births)
    assert ids(engine.check_rows(df, [rules.future_date(as_of=AS_OF)])) == [2, 4]
    assert ids(engine.check_rows(df, [rules.age_range(min_age=0, as_of=AS_OF)])) == [2, 4]


def test_age_bounds_are_inside(spark):
    births = [date(2006, 6, 15), date(2006, 6, 16), date(1904, 6, 15), date(1903, 6, 15), None]
    found = engine.check_rows(
        column(spark, "birth_date", DATE, births), [rules.age_range(as_of=str(AS_OF))]
    )
    assert tuples(found, "client_id", "offender", "rule_params") == [
        (1, "2006-06-16", '{"age":17,"max":120,"min":18}'),
        (3, "1903-06-15", '{"age":121,"max":120,"min":18}'),
    ]


def test_without_a_date_rules_go_by_today(spark):
    df = column(spark, "birth_date", DATE, [date(1990, 1, 1), date(9999, 1, 1)])
    assert ids(engine.check_rows(df, [rules.future_date()])) == [1]


PHONES = [
    "(11)99999-9999",
    "(11) 99999-9999",
    "(11)9999-9999",
    "11 99999-9999",
    "(11)99999-9999\n",
    "(١١)99999-9999",
    "",
    None,
]


def test_lenient_and_strict_phones(spark):
    df = column(spark, "phone", TEXT, PHONES)
    assert ids(engine.check_rows(df, [rules.pattern()])) == [3, 4, 5, 6]
    cleaned = df.select("client_id", null_unless(F.col("phone")).alias("phone")).na.drop()
    assert [r.client_id for r in cleaned.collect()] == [0]


def test_phone_area_and_variety(spark):
    phones = ["(11)91234-5678", "(20)91234-5678", "(11)11111-1111", "no phone", None]
    found = engine.check_rows(column(spark, "phone", TEXT, phones), [rules.phone_extra()])
    assert tuples(found, "client_id", "rule_params") == [
        (1, '{"area_code":"20","digits":10}'),
        (2, '{"area_code":"11","digits":1}'),
    ]


@pytest.mark.parametrize(
    "later, earlier, months",
    [
        ("2024-02-29", "2004-02-29", 240),
        ("2023-02-28", "2004-02-29", 228),
        ("2023-03-30", "2004-03-31", 227.96774194),
        ("2024-04-30", "2000-03-31", 289),
    ],
)
def test_months_and_years(spark, later, earlier, months):
    born = F.lit(earlier).cast("date")
    row = spark.range(1).select(
        fractional_years(born, reference_date(later)).alias("exact"),
        completed_years(born, reference_date(later)).alias("whole"),
    ).first()
    assert row.exact == months / 12 and row.whole == int(months // 12)


def test_months_and_age_bounds_agree_with_the_built_in(spark):
    span = F.lit(60_000)
    day = F.date_add(F.lit("1880-01-01").cast("date"), F.pmod(F.xxhash64("id"), span).cast("int"))
    other = F.date_add(
        F.lit("1880-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), span).cast("int")
    )
    pairs = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.last_day(day)).otherwise(day).alias("a"),
        F.when(F.col("id") % 2 == 0, F.last_day(other)).otherwise(other).alias("b"),
    )
    mine, built_in = months_apart(F.col("a"), F.col("b")), F.months_between("a", "b")
    assert pairs.where(mine != built_in).count() == 0
    # Near a bound: births within a week of the day on which the years are completed.
    close = pairs.select("a", F.explode(F.array(*[F.lit(n) for n in range(-5, 6)])).alias("n"))
    close = close.select("a", F.date_add(F.add_months("a", -12 * 18), F.col("n")).alias("b"))
    done = F.floor(F.months_between("a", "b") / 12) >= 18
    assert close.where(done != (F.col("b") <= latest_birth(F.col("a"), 18))).count() == 0


def test_age_range_reaches_the_scan(spark, folder):
    column(spark, "birth_date", DATE, [AS_OF] * 5).write.parquet(folder + "/t")
    found = engine.check_rows(spark.read.parquet(folder + "/t"), [rules.age_range(as_of=AS_OF)])
    pushed = "PushedFilters: [Or(GreaterThan(birth_date,2006-06-15),LessThanOrEqual("
    assert pushed in final_plan(found)


def test_age_before_birth_is_minus_one(spark):
    born = F.lit("2025-01-01").cast("date")
    age = completed_years(born, reference_date("2024-01-01"))
    assert spark.range(1).select(age).first()[0] == -1


# The mean rule.


def outliers(df, multiplier=3.0):
    return engine.check_rows(df, [rules.mean_outlier(df, "income", multiplier)])


def test_mean_outlier_is_exact(spark):
    dice = random.Random(3)
    for _ in range(6):
        n = dice.randrange(1, 40)
        cents = [dice.choice([dice.randrange(-500, 500), dice.randrange(10**10)]) for _ in range(n)]
        cents += [3 * sum(cents) // n + d for d in (-1, 0, 1)]
        cents = [c for c in cents if abs(c) < 10**10]
        values = [Decimal(c).scaleb(-2) for c in cents] + [None]
        expected = [i for i, c in enumerate(cents) if c * len(cents) > 3 * sum(cents)]
        assert ids(outliers(column(spark, "income", MONEY, values))) == expected


@pytest.mark.parametrize("kind", ["decimal(18,8)", "decimal(18,0)", "decimal(5,5)"])
def test_mean_outlier_is_exact_for_other_scales(spark, kind):
    precision, scale = map(int, kind[8:-1].split(","))
    dice = random.Random(4)
    units = [dice.randrange(10 ** (precision - 1)) for _ in range(20)]
    mean = sum(units) * 12345 // (len(units) * 10000)
    units += [mean + d for d in (-1, 0, 1) if mean + d < 10**precision]
    values = [Decimal(u).scaleb(-scale) for u in units]
    expected = [i for i, u in enumerate(units) if u * len(units) * 10000 > 12345 * sum(units)]
    df = column(spark, "income", MONEY, []).select("client_id", F.col("income").cast(kind))
    found = outliers(spark.createDataFrame(list(enumerate(values)), df.schema), 1.2345)
    assert ids(found) == expected != []


def test_mean_outlier_at_the_threshold(spark):
    # The mean is 1/3: above 3 times the mean is above exactly 1.
    values = [Decimal("1.00"), Decimal("0.00"), Decimal("0.00")]
    assert ids(outliers(column(spark, "income", MONEY, values))) == []
    # The mean is 0.6733..: twice that is 1.3466.., of which the cents are 1.34.
    values = [Decimal("1.35"), Decimal("0.67"), Decimal("0.00")]
    found = outliers(column(spark, "income", MONEY, values), 2.0)
    assert tuples(found, "client_id", "rule_params") == [
        (0, '{"multiplier":2.0,"threshold":"1.34"}')
    ]


def test_mean_outlier_without_values(spark):
    assert outliers(column(spark, "income", MONEY, [])).count() == 0
    assert outliers(column(spark, "income", MONEY, [None, None])).count() == 0


def test_mean_outlier_at_the_ends_of_the_type(spark):
    top = Decimal("99999999.99")
    assert ids(outliers(column(spark, "income", MONEY, [top, top]))) == []
    assert ids(outliers(column(spark, "income", MONEY, [-top, -top, Decimal(1)]))) == [0, 1, 2]


def test_mean_outlier_of_doubles(spark):
    df = column(spark, "income", schema.DOUBLE, [1.0, 1.0, 1.0, 100.0, None])
    assert ids(outliers(df)) == [3]


def test_mean_threshold_reaches_the_scan(spark, folder):
    column(spark, "income", MONEY, [Decimal(n) for n in range(50)]).write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    plan = outliers(df, 1.5)
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(income,ScalarSubquery" in text


# The address rule.

ADDRESS = struct(client_id=LONG, country=TEXT, city=TEXT, street=TEXT, house_no=TEXT)


def test_addresses(spark):
    known = spark.createDataFrame(
        [("BR", "SP", "A", "1"), ("BR", "SP", "A", "1"), ("BR", "SP", None, "2")],
        schema.struct(country=TEXT, city=TEXT, street=TEXT, house_no=TEXT),
    )
    df = spark.createDataFrame(
        [(1, "BR", "SP", "A", "1"), (2, "BR", "SP", "A", "2"), (3, "BR", "SP", None, "2")], ADDRESS
    )
    found = engine.check_reference(df, rules.ReferenceRule(known))
    assert tuples(found, "client_id", "analyzed_column", "offender") == [
        (2, "country/city/street/house_no", "BR | SP | A | 2"),
        (3, "country/city/street/house_no", "BR | SP | 2"),
    ]


def test_reference_is_loaded_once_per_combination(spark, folder):
    known = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", None)], "x string, y string")
    engine.write_reference(known, folder + "/r", ["x", "y"])
    assert tuples(spark.read.parquet(folder + "/r")) == [("a", "b")]


def test_a_hot_address_is_split_over_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings if spark.conf.get(name, None)}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string")
        df = spark.range(0, 60_000, 1, 8).select(
            F.col("id").alias("client_id"),
            F.lit("BR").alias("country"),
            F.lit("SP").alias("city"),
            F.lit("A").alias("street"),
            number.alias("house_no"),
        )
        known = df.select(*ADDRESS.names[1:]).where("house_no <> '1'").distinct()
        known.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/known")
        known = spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/known")
        found = engine.check_reference(df, rules.ReferenceRule(known))
        plan = final_plan(found)
        assert ids(found) == [1]
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for name in settings:
            spark.conf.unset(name)
        for name, value in before.items():
            spark.conf.set(name, value)


# Reports.

CLIENT = struct(
    client_id=LONG, name=TEXT, country=TEXT, city=TEXT, street=TEXT, house_no=TEXT, phone=TEXT,
    birth_date=DATE, updated_at=TIME, person_type=TEXT, income=MONEY,
)


def clients(spark, n=200):
    dice = random.Random(8)
    rows = [
        (
            i,
            dice.choice(["ANA", "BO", None]),
            "BR",
            "SP",
            dice.choice(["A", "B"]),
            dice.choice(["1", "2", None]),
            dice.choice(["(11)99999-9999", "(11) 99999-9999", "x", None]),
            date(dice.choice([1890, 1950, 1990, 2050]), 1, 1),
            datetime(2024, 1, 1),
            dice.choice(["PF", "PJ", "XX", None]),
            Decimal(dice.choice([-1, 5, 7, 9, 900])),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, CLIENT)


def test_report_is_the_sum_of_its_rules(spark):
    df = clients(spark)
    known = df.where("street = 'A'")
    chosen = report.client_rules(df, known, AS_OF)
    whole = Counter(map(tuple, engine.run(df, chosen).drop("checked_at").collect()))
    single = Counter()
    for rule in chosen:
        single.update(map(tuple, engine.run(df, [rule]).drop("checked_at").collect()))
    assert whole == single and len({row[0] for row in whole}) == 7


def test_report_has_one_schema_and_adds_the_phones_of_bronze(spark):
    df = clients(spark)
    silver = df.withColumn("phone", null_unless(F.col("phone")))
    stamp = F.lit("2024-06-15 00:00:00").cast("timestamp")
    found = report.quality_report(silver, df, df.where("street = 'A'"), AS_OF, stamp)
    assert found.columns == [
        "rule", "analyzed_column", "client_id", "offender", "rule_params", "checked_at",
    ]
    assert found.where("rule = 'phone_pattern'").count() == df.where("phone = 'x'").count() > 0
    for row in found.select("rule_params").distinct().collect():
        json.loads(row.rule_params)


def test_row_rules_share_one_scan(spark, folder):
    clients(spark).write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    chosen = [r for r in report.client_rules(df, None, AS_OF) if r.name != "salary_discrepant_mean"]
    final = final_plan(engine.check_rows(df, chosen)).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "Exchange" not in final


def test_recorded_runs_are_replaced_by_a_rerun(spark, folder):
    df = clients(spark)
    found = engine.run(df, [rules.negative()], F.lit("2024-06-15").cast("timestamp"))
    engine.record(found, folder + "/v", "20240614")
    for _ in range(2):
        engine.record(found, folder + "/v", "20240615")
    kept = engine.recorded(spark, folder + "/v", found.schema)
    assert kept.count() == 2 * found.count() > 0
    engine.record(found.limit(0), folder + "/v", "20240615")
    assert engine.recorded(spark, folder + "/v", found.schema).count() == found.count()
    assert engine.recorded(spark, folder + "/none", found.schema).count() == 0


def carried(df, *chosen):
    return engine.check_rows(df, list(chosen), carry=("updated_at",))


def test_only_new_versions_are_recorded_again(spark, folder):
    df, path = clients(spark), folder + "/v"
    found = carried(df, rules.negative())
    engine.record(found, path, "20240101")
    known = engine.recorded(spark, path, found.schema)
    assert engine.not_yet_recorded(found, known, "20240102").count() == 0
    newer = df.withColumn("updated_at", F.lit("2024-02-02 00:00:00").cast("timestamp_ntz"))
    later = carried(newer, rules.negative())
    assert engine.not_yet_recorded(later, known, "20240102").count() == found.count() > 0


def test_a_run_made_again_records_all_of_it_again(spark, folder):
    path = folder + "/v"
    found = carried(clients(spark), rules.negative())
    for _ in range(2):
        known = engine.recorded(spark, path, found.schema)
        engine.record(engine.not_yet_recorded(found, known, "20240101"), path, "20240101")
    assert engine.recorded(spark, path, found.schema).count() == found.count() > 0


def test_a_rule_added_later_sees_recorded_rows(spark, folder):
    df, path = clients(spark), folder + "/v"
    found = carried(df, rules.negative())
    engine.record(found, path, "20240101")
    both = carried(df, rules.negative(), rules.negative("client_id"), rules.required(["phone"]))
    known = engine.recorded(spark, path, found.schema)
    left = engine.not_yet_recorded(both, known, "20240102")
    assert left.count() == carried(df, rules.required(["phone"])).count() > 0


def test_versions_without_a_time_are_recorded_once(spark, folder):
    path = folder + "/v"
    df = clients(spark).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    found = carried(df, rules.negative())
    engine.record(found, path, "20240101")
    known = engine.recorded(spark, path, found.schema)
    assert engine.not_yet_recorded(found, known, "20240102").count() == 0


def test_no_rules_are_an_error(spark):
    for check in (engine.check_rows, engine.run):
        with pytest.raises(ValueError, match="no rules"):
            check(clients(spark), [])


def test_reference_under_its_own_names(spark):
    df = clients(spark)
    theirs = df.select(F.col("country").alias("land"), F.col("city").alias("ort")).limit(1)
    rule = rules.ReferenceRule(theirs, ("country", "city"), reference_columns=("land", "ort"))
    same = rules.ReferenceRule(theirs.toDF("country", "city"), ("country", "city"))
    found = engine.check_reference(df, rule)
    assert tuples(found) == tuples(engine.check_reference(df, same))
    assert found.columns[:2] == ["rule", "analyzed_column"]


@pytest.mark.parametrize("kind", ["decimal(18,2)", "decimal(19,2)", "decimal(38,2)", "decimal(38,19)"])
def test_mean_of_any_decimal_is_exact(spark, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["0.01", "0.02", "0.02", "0.06"])], "client_id int, v string")
    df = df.select("client_id", F.col("v").cast(kind).alias("income"))
    rule = rules.mean_outlier(df, "income", 2.0)
    found = engine.check_rows(df, [rule]).collect()
    assert [r.client_id for r in found] == [3]  # the mean is 0.0275
    shown = json.loads(found[0].rule_params)["threshold"]
    places = int(kind.partition(",")[2][:-1])
    assert Decimal(shown) == (Decimal("0.05") if places == 2 else Decimal("0.055"))


def test_mean_of_the_widest_decimals(spark):
    units = [10**38 - 1, 10**38 - 2, -(10**38) + 1, 5, 10**37, 3 * 10**37 + 7]
    df = spark.createDataFrame([(i, str(u)) for i, u in enumerate(units)], "client_id int, v string")
    df = df.select("client_id", F.col("v").cast("decimal(38,0)").alias("income"))
    for multiplier in (0.5, 1.0, 1.25):
        want = {i for i, u in enumerate(units) if u * len(units) * 100 > sum(units) * int(multiplier * 100)}
        found = engine.check_rows(df, [rules.mean_outlier(df, "income", multiplier)])
        assert {r.client_id for r in found.collect()} == want


def test_too_many_places_are_refused(spark):
    df = spark.range(1).select(F.lit(0).cast("decimal(38,20)").alias("income"))
    with pytest.raises(ValueError, match="at most 19 places"):
        rules.mean_outlier(df)


def test_names_go_both_ways():
    assert schema.CANONICAL["num_telefone_cliente"] == "phone"
    assert {schema.ORIGINAL[name] for name in schema.BUSINESS_COLUMNS} == {
        landed for _, landed, _, _ in schema.CLIENT_COLUMNS
    }
