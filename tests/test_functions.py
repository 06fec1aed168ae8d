import difflib
import hashlib
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.functions.extraction import render_prompt, strip_code_fence
from quayside.functions.money import amount_text, coerce_revenue_lenient, parse_revenue_strict
from quayside.functions.naming import camel_to_snake, snake_case_json, snake_case_schema
from quayside.functions.payload import with_content_key, with_payload_fields
from quayside.functions.similarity import (
    bags_within,
    character_bag,
    indel_ratio,
    lcs_length,
    within_distance,
)
from quayside.functions.text import (
    ENTITY_SUFFIXES,
    normalise_company_name,
    normalise_state,
    quoted,
    title_case,
    token_sort,
    zip_prefix,
)


def column_of(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


def test_company_names_lose_legal_forms_case_and_punctuation(spark):
    """Every legal form, behind a name of two words, in three spellings and four kinds of joint."""
    spellings = (str.lower, str.upper, str.title)
    joints = (" {}", ", {}", " ({})", " - {}.")
    cases = {
        f"{case('quill')} {case('anchorage')}{joint.format(case(form))}": "quill anchorage"
        for form in ENTITY_SUFFIXES for case in spellings for joint in joints
    }
    assert len(cases) > 200
    assert column_of(spark, list(cases), normalise_company_name) == list(cases.values())


def test_company_names_of_odd_words(spark):
    cases = {
        "Zoë's Tee-Stube 24/7": "zoë tee stube 24",
        "incline corporal cooper": "incline corporal cooper",
        "A B C": "",
        "plc_9 GmbH & Söhne AG": "plc_9 söhne",
        "\t\u3000Ostwind\u00a0Segel ": "ostwind segel",
        "--..--": "",
    }
    assert column_of(spark, list(cases), normalise_company_name) == list(cases.values())


def test_title_case_matches_python(spark):
    words = ["e-commerce", "food & drink", "retail", "WEAPONS manufacturing", "o'neil's", "3d print",
             " été-club ", "a1b2", "", "x--y  z"]
    assert column_of(spark, words, title_case) == [w.strip().title() for w in words]


def test_state_zip_and_token_sort(spark):
    assert column_of(spark, [" ny ", "\tca ", "New York"], normalise_state) == [
        "NY", "CA", "NEW YORK",
    ]
    assert column_of(spark, [" 10001-55", None, "902"], zip_prefix) == ["10001", "", "902"]
    assert column_of(spark, ["machines ibm", "b a c"], token_sort) == ["ibm machines", "a b c"]


def test_revenue_parsers(spark):
    strict = ["$5,000,000", "5000000", "not-a-number", " 1 000 ", "-12.5", None, "1_000", ""]
    assert column_of(spark, strict, parse_revenue_strict) == [
        Decimal(5000000), Decimal(5000000), None, Decimal(1000), Decimal("-12.5"), None,
        Decimal(1000), None,
    ]
    lenient = ["$5,000,000", "4.5M", "500k", "not-a-number", None, "2B", "k", "1e3"]
    assert column_of(spark, lenient, coerce_revenue_lenient) == [
        Decimal(5000000), Decimal(4500000), Decimal(500000), None, None, Decimal(2000000000),
        None, Decimal(1000),
    ]


def test_amount_text_keeps_written_decimals(spark):
    shown = column_of(
        spark,
        ["600000000", "600000000.00", "-1234.5", "$9,999"],
        lambda v: amount_text(parse_revenue_strict(v), v),
    )
    assert shown == ["600,000,000", "600,000,000.00", "-1,234.5", "9,999"]


def test_code_fences(spark):
    raw = ['```json\n{"a":1}\n```', '```\n{"a":1}```', ' {"a":1} ', "plain"]
    assert column_of(spark, raw, strip_code_fence) == ['{"a":1}'] * 3 + ["plain"]


def test_prompt_reminder_only_on_retry(spark):
    first = column_of(spark, ["text"], lambda v: render_prompt(v, F.lit(1)))[0]
    second = column_of(spark, ["text"], lambda v: render_prompt(v, F.lit(2)))[0]
    assert "REMINDER" not in first and first.endswith("Text:\ntext")
    assert second.startswith(first) and "REMINDER" in second


def test_payload_must_be_one_json_object(spark):
    texts = ['{"a":1}', '{"a":1} x', '{"a":1},{"b":2}', "[1]", "5", "", None, '{"a":1}],[1',
             "{'a':1}", "null", ' {"a":1} ']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = with_payload_fields(df, F.col("t"), ["a"]).orderBy("i").collect()
    assert [r.is_object for r in rows] == [True] + [False] * 9 + [True]


def keys(spark, payloads, **options):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p string")
    return [r.k for r in with_content_key(df, "p", "k", **options).orderBy("i").collect()]


def test_content_key_properties(spark):
    base = {"company_id": "C-4711", "revenue": 5000000, "industry": "Retail"}
    flipped = {"industry": "Retail", "revenue": 5000000, "company_id": "C-4711"}
    other = {**base, "revenue": 9999999}
    later = {**base, "received_at": "2024-01-01T00:00:00Z"}
    nested = {**base, "x": {"b": [1, {"d": 1, "c": 2}], "a": 0}}
    nested_flipped = {"x": {"a": 0, "b": [1, {"c": 2, "d": 1}]}, **flipped}
    k = keys(spark, [json.dumps(p) for p in (base, flipped, other, later, nested, nested_flipped)])
    assert k[0] == k[1] == k[3] and k[0] != k[2] and k[4] == k[5] != k[0]
    assert all(len(x) == 64 for x in k)
    full = keys(spark, [json.dumps(base), json.dumps(later), json.dumps(flipped)], exclude=())
    assert full[0] == full[2] != full[1]
    notes = [json.dumps({**base, "note": n}) for n in "ab"]
    assert len(set(keys(spark, notes, exclude=["note"]))) == 1
    assert len(set(keys(spark, notes, exclude=[]))) == 2


def test_odd_payloads_keep_their_keys(spark):
    """The hashed texts, written out: field by field they are what the whole object would be."""
    expected = {
        '{"b":1,"a":null,"c":[null,{"z":null,"y":"q"}]}': '{"a":null,"b":1,"c":[null,{"y":"q","z":null}]}',
        '{"a":"\\u0001\\"ü"}': '{"a":"\\u0001\\"ü"}',
        '{"a":1.10}': '{"a":1.1}',
        '{"a":1e5}': '{"a":100000.0}\n1e5',
        '{"a":"x7E+05"}': '{"a":"x7E+05"}\n7E+05',
        '{"a":"' + "1" * 38 + '"}': '{"a":"' + "1" * 38 + '"}\n' + "1" * 38,
        '{"a":"' + "1" * 37 + '"}': '{"a":"' + "1" * 37 + '"}',
        '{"a":".e5"}': '{"a":".e5"}',
        '[1e5]': '[1e5]', '"{1e5"': '"{1e5"', '{"a":1}x': '{"a":1}x',
    }
    for options in ({}, {"exclude": ()}):
        assert keys(spark, list(expected), **options) == [hashlib.sha256(t.encode()).hexdigest() for t in expected.values()]


def test_camel_to_snake(spark):
    names = ["riskScore", "HTTPSEnabled", "companyId", "risk_score", "lossRatio2024Value"]
    assert column_of(spark, names, camel_to_snake) == [
        "risk_score", "https_enabled", "company_id", "risk_score", "loss_ratio2024_value",
    ]


def test_snake_case_schema_reaches_nested_names(spark):
    df = spark.createDataFrame(
        [("X", (0.5, [(1,)]), {"aB": 2})],
        "companyId string, riskData struct<lossRatio:double,claimsHistory:array<struct<claimId:int>>>,"
        " extraInfo map<string,int>",
    )
    row = snake_case_schema(df).first().asDict(recursive=True)
    assert row == {
        "company_id": "X",
        "risk_data": {"loss_ratio": 0.5, "claims_history": [{"claim_id": 1}]},
        "extra_info": {"a_b": 2},
    }


def test_snake_case_json_leaves_values_alone(spark):
    text = json.dumps({"riskScore": 1, "subData": [{"lossRatio": "keepThis: \"aB\""}], "s": "camelCase"})
    out = json.loads(column_of(spark, [text], snake_case_json)[0])
    assert out == {"risk_score": 1, "sub_data": [{"loss_ratio": 'keepThis: "aB"'}], "s": "camelCase"}


def dynamic_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@pytest.mark.parametrize("longest", [8, 40, 150])
def test_lcs_matches_dynamic_programming(spark, longest):
    rng = random.Random(longest)
    word = lambda: "".join(rng.choice("abcdé 1") for _ in range(rng.randint(1, longest)))
    rows = [(a, b, dynamic_lcs(a, b)) for a, b in ((word(), word()) for _ in range(150))]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    assert df.filter(lcs_length("a", "b") != F.col("n")).count() == 0
    # The cheap bound may never refuse a pair that reaches the threshold.
    lost = df.filter(
        ~within_distance(F.col("a"), F.col("b"), 90.0)
        & ((F.length("a") + F.length("b") - 2 * F.col("n")) * 10 <= F.length("a") + F.length("b"))
    )
    assert lost.count() == 0
    distance = F.length("a") + F.length("b") - 2 * F.col("n")
    bags = bags_within(character_bag(F.col("a")), character_bag(F.col("b")), distance)
    assert df.filter(~bags).count() == 0


def test_indel_ratio_edges(spark):
    df = spark.createDataFrame([("", ""), ("a", ""), ("abc", "abc"), ("marlow", "marlows")], "a string, b string")
    got = [r.x for r in df.select(indel_ratio(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got[:3] == [100.0, 0.0, 100.0]
    assert got[3] == pytest.approx(100 * difflib.SequenceMatcher(None, "marlow", "marlows").ratio())


def test_amounts_are_not_rounded_across_a_limit(spark):
    from decimal import Decimal

    texts = ["500000000.0000001", "9999.9999999", "9999.9999999999999", "-0.5", "5", "1e3", "x"]
    got = column_of(spark, texts, parse_revenue_strict)
    assert got[0] > 500_000_000 and got[1] < 10_000
    assert Decimal(10_000) == got[2] or got[2] < 10_000
    assert got[3:] == [Decimal("-0.5"), 5, 1000, None]
    more = column_of(spark, ["500000000.0000000000000001", "-1.0000000000000009"], parse_revenue_strict)
    assert more[0] > 500_000_000 and more[1] < -1


def test_signs_and_quotes_in_messages(spark):
    shown = column_of(spark, ["-0.5", "-1234.50", "-0.00", "7.25"], lambda c: amount_text(parse_revenue_strict(c), c))
    assert shown == ["-0.5", "-1,234.50", "-0.00", "7.25"]
    texts = ["plain", "O'x", 'say "hi"', "both ' and \"", "back\\slash", "tab\tline\n", "bell\x07", "é", ""]
    texts += ["a\u200bb", "\u2028", "\ufeffx", "\u3000", "\ue000", "\U000e0001z", "😀\u202e", "\x85"]
    assert column_of(spark, texts, quoted) == [repr(t) for t in texts]


def test_snake_case_json_takes_long_strings(spark):
    long = "x" * 1_000_000 + '\\"{\\"aKey\\": 1}' + '\\\\' * 1000
    document = '{"someKey": "' + long + '", "aB": [{"cD": "eF: \\"gH\\": "}, 5], "trailing\\\\": "iJ"}'
    expected = document.replace('"someKey"', '"some_key"').replace('"aB"', '"a_b"').replace('"cD"', '"c_d"')
    assert column_of(spark, [document], snake_case_json) == [expected]


def test_big_numbers_have_keys_of_their_own(spark):
    big = "123456789012345678901234567890123456789012"
    texts = [f'{{"a":{big}}}', f'{{"a":{big[:-1]}3}}', '{"a":0.12345678901234567891e1,"b":2}',
             '{"b":2,"a":0.12345678901234567891e1}', '{"a":0.12345678901234567892e1,"b":2}', '{"a":5}', '{"a":5.0}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, payload string")
    keys = [r["k"] for r in with_content_key(df, "payload", "k").orderBy("i").collect()]
    assert len(set(keys)) == 5 and keys[2] == keys[3] and keys[5] == keys[6]
