import pytest
from pyspark.sql import functions as F

from tillflow import fixed_values as fv
from tillflow.functions import dates, money, people, records, text
from tillflow.schemas import APP_LOG, ORDER_INFO


def values(frame, column):
    return [r[0] for r in frame.select(column).collect()]


def test_rounding_goes_up_at_the_half(rows):
    frame = rows("x double", (0.125,), (-0.025,), (2.5,), (1.005,), (None,))
    assert values(frame, money.round_half_up(F.col("x"))) == [0.13, -0.02, 2.5, 1.0, None]


def test_share_is_rounded_and_never_overflows(rows):
    huge = 9 * 10**15
    frame = rows(
        "a bigint, o bigint, f bigint",
        (4000, 12000, 10000), (1, 2, 1), (0, 0, 500), (huge, huge, huge), (huge, 3 * huge, 10**9),
        (None, 10, 10),
    )
    share = money.share_cents(F.col("a"), F.col("o"), F.col("f"))
    assert values(frame, share) == [3333, 1, None, huge, 333333333, None]


def test_sum_is_exact_beyond_64_bits(rows):
    big = 2**62
    frame = rows("x bigint", (big,), (big,), (big,), (-5,))
    assert values(frame, money.sum_cents(F.col("x"))) == [3 * big - 5]
    assert values(frame.limit(0), money.sum_cents(F.col("x"))) == [None]


def test_age_counts_years_of_365_days(rows):
    frame = rows("b string", ("1991-04-15",), ("2001-04-08",), ("2021-04-08",), ("no date",), (None,))
    age = people.age_in_years(F.col("b"), F.lit("2021-04-08").cast("date"))
    assert values(frame, age) == [30, 20, 0, None, None]


def test_age_groups_at_their_borders(rows):
    frame = rows("age int", (19,), (20,), (30,), (31,), (None,))
    assert values(frame, people.age_group(F.col("age"))) == [
        fv.AGE_UP_TO_20, fv.AGE_21_TO_30, fv.AGE_21_TO_30, fv.AGE_OVER_30, None
    ]


def test_every_gender_but_m_is_female(rows):
    frame = rows("g string", ("M",), ("F",), (None,), ("m",))
    assert values(frame, people.gender_name(F.col("g"))) == [
        fv.GENDER_MALE, fv.GENDER_FEMALE, fv.GENDER_FEMALE, fv.GENDER_FEMALE
    ]


def test_dates_are_zero_padded(rows):
    frame = rows("ms bigint, t string", (1617494400000 + 3 * 3600_000, "2021-04-04 03:05:09"))
    got = frame.select(
        dates.day_text(dates.moment(F.col("ms"))), dates.hour_text(dates.moment(F.col("ms"))),
        dates.date_part_of(F.col("t")), dates.hour_part_of(F.col("t")), dates.hour_number(F.col("t")),
    ).first()
    assert tuple(got) == ("2021-04-04", "03", "2021-04-04", "03", 3)


def test_previous_day():
    assert dates.previous_day("2024-03-01") == "2024-02-29"
    with pytest.raises(ValueError):
        dates.previous_day("yesterday")


def test_records_take_numbers_in_both_forms_and_leave_out_broken_text(rows):
    messages = rows(
        "value string",
        ('{"id":"12","user_id":7,"final_total_amount":"10.5","create_time":"t"}',),
        ('{"id":"x1","user_id":null,"extra":1}',),
        ("{broken",), (None,), ("",),
    )
    got = records.parse_records(messages, ORDER_INFO).select(
        "id", "user_id", "final_total_amount", "create_time"
    )
    assert [tuple(r) for r in got.collect()] == [(12, 7, 10.5, "t"), (None, None, None, None)]
    assert [r.value for r in records.malformed(messages).collect()] == ["{broken", None, ""]


def test_nested_log_and_its_message(rows):
    messages = rows("value string", ('{"common":{"mid":"m1","uid":"u"},"start":{"entry":"icon"},"ts":5}',))
    log = records.parse_records(messages, APP_LOG)
    assert log.select("common.mid", "start", "ts").first() == ("m1", '{"entry":"icon"}', 5)
    sent = records.to_messages(log.select("ts", "start"), "T", key="ts").first()
    assert (sent.topic, sent.key) == ("T", "5") and '"ts":5' in sent.value


def test_words_are_whole_and_of_any_script(rows):
    frame = rows("t string", ("A Red hat",), ("bored",), ("écred",), ("x,red.",), ("red",), ("redé",), (None,))
    assert values(frame, text.has_word(F.col("t"), "red")) == [True, False, False, True, True, False, None]


ODD = [
    '"text"', "5", "[1]", "null", "[]", '[{"id":1},{"id":2}]', '[{"id":1}]', '{"id":1} trailing', '{"id":1},{"id":2}',
    '{"id":1}]', '{"id":1', "", " ", None, "{broken", "true", '{"id":1}] [{"id":2}',
]
SOUND = ['{"id":1}', ' {"id":"2"} ', "{}", '{"id":null}', '{"id":"x"}', '{"common":"x","id":3}']


def test_records_and_rejects_are_complements(rows):
    messages = rows("key string, value string", *[(str(i), t) for i, t in enumerate([*ODD, *SOUND])])
    left_out = records.rejects(messages, ORDER_INFO)
    assert sorted(int(r.key) for r in left_out.collect()) == list(range(len(ODD)))
    taken = records.parse_records(messages, ORDER_INFO, keep=["key"])
    assert {r.key: r.id for r in taken.collect()} == {
        str(len(ODD) + i): n for i, n in enumerate([1, 2, None, None, None, 3])
    }
    repeated = rows("key string, value string", ("a", '{"id":1,"id":2}'))
    assert records.parse_records(repeated, ORDER_INFO).count() + records.rejects(repeated, ORDER_INFO).count() == 1


def test_a_required_field_must_be_readable(rows):
    needs = {"id": "bigint", "create_time": "timestamp"}
    messages = rows(
        "value string",
        ('{"id":"1","create_time":"2021-04-08 10:00:00"}',), ('{"id":"1","create_time":"soon"}',),
        ('{"id":"x","create_time":"2021-04-08 10:00:00"}',), ('{"create_time":"2021-04-08 10:00:00"}',), ("5",),
    )
    assert records.parse_records(messages, ORDER_INFO, required=needs).count() == 1
    assert records.rejects(messages, ORDER_INFO, required=needs).count() == 4
