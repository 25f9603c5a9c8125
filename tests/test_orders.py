from conftest import as_set

from tillflow.operators import dims, keyed, orders, visits

ORDERS = "id bigint, user_id bigint, create_time string"


def test_one_first_order_per_user_ties_by_id(rows):
    frame = rows(
        ORDERS,
        (3, 1, "2021-04-01 10:00:00"), (2, 1, "2021-04-01 10:00:00"), (1, 1, "2021-04-02 00:00:00"),
        (9, 2, "2021-04-01 00:00:00"),
    )
    flags = as_set(orders.flag_first_orders(frame), "id", "if_first_order")
    assert flags == {(3, "0"), (2, "1"), (1, "0"), (9, "1")}


def test_users_in_the_state_have_no_first_order(rows):
    frame = rows(ORDERS, (1, 1, "a"), (2, 2, "a"), (3, 3, "a"))
    state = rows("user_id string, if_consumed string", ("1", "1"), ("2", "0"), ("x", "1"))
    flagged = orders.flag_first_orders(frame, state)
    assert as_set(flagged, "id", "if_first_order") == {(1, "0"), (2, "1"), (3, "1")}
    assert as_set(orders.new_customers(flagged)) == {("2", "1"), ("3", "1")}


def test_lookups_keep_rows_that_miss(rows):
    frame = rows("id bigint, user_id bigint, province_id bigint, sku_id bigint", (1, 10, 5, 7), (2, 11, None, 8))
    provinces = rows("id string, name string, area_code string, iso_code string, iso_3166_2 string", ("5", "n", "a", "i", "3"))
    users = rows("id string, age_group string, gender_name string", ("10", "g", "f"))
    skus = rows(
        "id string, spu_id string, tm_id string, category3_id string, spu_name string, tm_name string, category3_name string",
        ("7", "1", "2", "3", "s", "t", "c"),
    )
    full = orders.add_sku(orders.add_user(orders.add_province(frame, provinces), users), skus)
    assert as_set(full, "id", "province_iso_code", "user_age_group", "tm_id", "spu_name") == {
        (1, "i", "g", 2, "s"), (2, None, None, None, None)
    }


def test_sku_names_follow_their_own_ids(rows):
    skus = rows("id string, spu_id string, tm_id string, category3_id string", ("1", "20", "30", "40"), ("2", "30", "20", "41"))
    named = dims.name_skus(
        skus,
        rows("id string, name string, category2_id string", ("40", "cat", "1")),
        rows("id string, tm_name string", ("30", "tm30"), ("20", "tm20")),
        rows("id string, spu_name string", ("20", "spu20"), ("30", "spu30")),
    )
    assert as_set(named, "id", "tm_name", "spu_name", "category3_name") == {
        ("1", "tm30", "spu20", "cat"), ("2", "tm20", "spu30", None)
    }


def test_lookup_of_a_batch(rows):
    dim = rows("id bigint, v string", (1, "a"), (2, "b"), (3, "c"))
    batch = rows("k bigint", (1,), (1,), (3,), (None,))
    assert as_set(dims.rows_for_batch(dim, "id", batch, "k")) == {(1, "a"), (3, "c")}


def test_first_latest_and_distinct(rows):
    frame = rows("k int, v int, x string", (1, 1, "a"), (1, 2, None), (2, 5, "c"), (2, 5, "c"), (None, 1, "n"))
    assert as_set(keyed.first_by_key(frame, ["k"], ["v"])) == {(1, 1, "a"), (2, 5, "c"), (None, 1, "n")}
    assert as_set(keyed.latest_by_key(frame, ["k"], ["v"])) == {(1, 2, None), (2, 5, "c"), (None, 1, "n")}
    assert keyed.distinct_by_id(frame, ["k"]).count() == 3
    lost = rows("k int, j int, x string", (1, None, "a"), (1, None, "a"), (None, 2, "b"), (None, 2, "c"), (3, 4, "d"), (3, 4, "e"))
    assert keyed.distinct_by_id(lost, ["k", "j"]).count() == 5 and keyed.distinct_by_id(lost, ["k"]).count() == 4


LOG = "common struct<mid:string,uid:string,ar:string,ch:string,vc:string>, start string, ts bigint"
DAY = 86_400_000


def log(mid, ts, uid="u"):
    return ((mid, uid, "a", "c", "v"), None, ts)


def test_first_visit_per_day_and_device(rows):
    logs = rows(LOG, log("m", 5), log("m", 3), log("m", DAY + 1), log("n", 7), log("n", 7, "t"))
    first = visits.first_visits(logs)
    assert as_set(first, "mid", "uid", "dt", "hr", "mi", "ts") == {
        ("m", "u", "1970-01-01", "00", "00", 3),
        ("m", "u", "1970-01-02", "00", "00", DAY + 1),
        ("n", "t", "1970-01-01", "00", "00", 7),
    }
    starts = visits.visit_starts(logs)
    assert as_set(starts) == as_set(first, "dt", "mid", "ts")
    assert as_set(visits.dau_total(starts)) == {("1970-01-01", 2), ("1970-01-02", 1)}
    assert as_set(visits.new_devices(starts)) == {("1970-01-01", 2)}


def test_busiest_hours(rows):
    hours = rows("dt string, hr string, dau bigint", ("d", "02", 5), ("d", "01", 5), ("d", "00", 1), ("d", "03", 9))
    assert [r.hr for r in visits.busiest_hours(hours, 3).collect()] == ["03", "01", "02"]
