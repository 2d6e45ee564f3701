import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import evalmetrics as EV
from tessera.operators import teacher as TE

DOUBLES = [0.0, 0.7, 1.0, -2.5, 100000.0, 1e15, 1e16, 123456789012345680.0, 1e-4, 1e-5, 1.5e-7, 0.1 + 0.2, 1 / 3, 2e23, 5e-324, 1.7976931348623157e308, 2.2250738585072014e-308,
           4.35, 9007199254740993.0, 1e22, 1e100, 12345.678, 2.0e-3, 1.1e-5, 99.99999999999999, -0.001, 0.30000000000000004, float("nan"), float("inf"), float("-inf")]
STRINGS = ["", "plain", 'q"uote', "back\\slash", "a\nb\rc\td\be\ff", "\x00\x1f\x7f", "é", "日本", "😀x", " ", "a/b", "~ !#[]"]


def test_scalars_equal_python(spark):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(DOUBLES)], "i int, x double").select("i", TE.json_double("x").alias("j")).collect()
    assert {r.i: r.j for r in rows} == {i: json.dumps(x) for i, x in enumerate(DOUBLES)}
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(STRINGS)], "i int, x string").select("i", TE.json_string("x").alias("j")).collect()
    assert {r.i: r.j for r in rows} == {i: json.dumps(x) for i, x in enumerate(STRINGS)}


def test_nested_values_equal_python(spark):
    schema = T.StructType.fromDDL("z long, model string, stop array<string>, meta map<string, array<double>>, inner struct<b: boolean, a: struct<n: int>>")
    values = [(3, "m", ["\n", None], {"zeta": [0.5], "alpha": [1e-9, None], "Beta": None}, (True, (4,))), (None, None, [], {}, (False, None)), (None, "é", None, None, None)]
    df = spark.createDataFrame(values, schema)
    got = [r[0] for r in df.select(TE.canonical_json(F.struct(*schema.names), schema)).collect()]
    want = []
    for z, model, stop, meta, inner in values:
        inner = None if inner is None else {"b": inner[0], "a": None if inner[1] is None else {"n": inner[1][0]}}
        want.append(json.dumps({"z": z, "model": model, "stop": stop, "meta": meta, "inner": inner}, sort_keys=True))
    assert got == want
    with pytest.raises(TypeError):
        TE.canonical_json(F.lit(b"x"), T.BinaryType())


def test_request_key_of_any_parameters(spark):
    df = spark.createDataFrame([("p", 0.2, "gpt-\"x\"")], "prompt string, t double, m string")
    key = df.select(TE.cache_key("prompt", TE.canonical_params("m", "t", F.lit(64)))).first()[0]
    raw = "p" + json.dumps({"model": 'gpt-"x"', "temperature": 0.2, "max_tokens": 64}, sort_keys=True)
    assert key == hashlib.sha256(raw.encode()).hexdigest()[:16]


def full_matrix(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_bit_parallel_distance():
    import random
    r = random.Random(3)
    for _ in range(400):
        a, b = ("".join(r.choice("abcé😀") for _ in range(r.randrange(0, 90))) for _ in range(2))
        if r.random() < 0.5:
            b = a[:40] + b[:5] + a[45:]
        d = full_matrix(a, b)
        assert EV.levenshtein_distance(a, b) == d
        for limit in (0, 3, d, d + 1):
            assert EV.levenshtein_distance(a, b, limit) == min(d, limit + 1)


def test_distance_of_long_texts_is_quick(spark):
    import random
    import time
    r = random.Random(4)
    a = "".join(r.choice("abcdefgh é") for _ in range(20000))
    b = "".join(r.choice("abcdefgh é") for _ in range(20000))
    start = time.perf_counter()
    d = EV.levenshtein_distance(a, b)
    assert time.perf_counter() - start < 1.0 and 8000 < d < 16000
    assert EV.levenshtein_distance(a, b, 50) == 51
    df = spark.createDataFrame([(a, a[:-1]), ("é", "e"), ("", ""), (None, "x")], "p string, t string")
    assert EV.edit_distance(df, "p", "t").first() == (4, round(2 / 3, 6))
