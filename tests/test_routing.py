import json
from itertools import product

from tillflow.operators.routing import route_canal, route_maxwell, split_app_log

KNOWN = [
    "order_info", "order_detail", "base_province", "user_info",
    "base_category3", "base_trademark", "spu_info", "sku_info",
]


def messages(rows, *texts):
    return rows("value string", *[(t,) for t in texts])


def test_maxwell_filter_for_all_tables_types_and_data(rows):
    types = ["insert", "update", "delete", "bootstrap-insert", None]
    cases = list(product([*KNOWN, "other"], types, [{"id": "1"}, {}, None]))
    texts = [json.dumps({"table": t, "type": k, "data": d}) for t, k, d in cases]
    got = sorted(r.topic for r in route_maxwell(messages(rows, *texts)).collect())
    expected = sorted(
        "ODS_" + t.upper()
        for t, k, d in cases
        if d and k != "delete" and t in KNOWN and (t != "order_info" or k == "insert")
    )
    assert got == expected


def test_maxwell_keeps_the_row_image_as_text(rows):
    sent = route_maxwell(messages(rows, '{"table":"spu_info","type":"insert","data":{"id":7,"n":{"a":1}}}'))
    assert json.loads(sent.first().value) == {"id": 7, "n": {"a": 1}}


def test_maxwell_survives_odd_messages(rows):
    odd = ["{broken", '{"table":"spu_info"}', '{"table":"spu_info","data":[1]}', '"text"', "[]", None]
    assert route_maxwell(messages(rows, *odd)).count() == 0


def test_canal_sends_one_message_per_element_whatever_the_type(rows):
    sent = route_canal(messages(
        rows,
        '{"table":"order_info","type":"DELETE","data":[{"id":"1"},{"id":2}]}',
        '{"table":"Any","data":[]}', '{"table":"any"}', "{broken",
    )).collect()
    assert [(r.topic, json.loads(r.value)) for r in sent] == [
        ("ODS_ORDER_INFO", {"id": "1"}), ("ODS_ORDER_INFO", {"id": 2})
    ]


def test_log_split(rows):
    texts = ['{"start":{"e":1}}', '{"start":"x"}', '{"start":""}', '{"start":null}', '{"page":1}', '{"start":{}}']
    topics = [r.topic for r in split_app_log(messages(rows, *texts), "S", "E").collect()]
    assert topics == ["S", "S", "E", "E", "E", "S"]


def test_routed_messages_carry_the_time_of_the_change(rows):
    maxwell = '{"table":"spu_info","type":"update","ts":7,"data":{"id":1}}'
    canal = '{"table":"spu_info","es":7000,"data":[{"id":1}]}'
    bare = '{"table":"spu_info","type":"update","data":[{"id":1}]}'
    feed = rows("value string, at bigint, position bigint", (maxwell, 5, 9))
    assert tuple(route_maxwell(feed).select("at", "position").first()) == (7000, 9)
    assert tuple(route_maxwell(messages(rows, maxwell)).select("at", "position").first()) == (7000, None)
    assert tuple(route_canal(messages(rows, canal)).select("at", "position").first()) == (7000, None)
    late = rows("value string, at bigint, position bigint", (bare, 5, 9))
    assert tuple(route_canal(late).select("at", "position").first()) == (5, 9)
