"""CNPJ digits, split, mask and check digits."""
import random

from cadastra.functions.identity import (DV1_WEIGHTS, DV2_WEIGHTS, cnpj_format, cnpj_is_valid, cnpj_mask,
                                         cnpj_split, only_digits)


def _dv(digits, weights):
    s = sum(int(d) * w for d, w in zip(digits, weights))
    return 0 if s % 11 < 2 else 11 - s % 11


def make_valid(base12: str) -> str:
    d1 = _dv(base12, DV1_WEIGHTS)
    d2 = _dv(base12 + str(d1), DV2_WEIGHTS)
    return base12 + str(d1) + str(d2)


def test_validation(spark):
    rng = random.Random(7)
    valid = [make_valid("".join(rng.choice("0123456789") for _ in range(12))) for _ in range(50)]
    broken = [v[:-1] + str((int(v[-1]) + 1) % 10) for v in valid]
    odd = ["11111111111111", "1234567800019", "", None, "abc", "12.345.678/0001-95"]
    rows = [(v, True) for v in valid] + [(v, False) for v in broken] + [(v, False) for v in odd[:-1]]
    df = spark.createDataFrame(rows, "c string, ok boolean")
    got = df.select("ok", cnpj_is_valid("c").alias("v")).collect()
    assert all(r.ok == r.v for r in got)


def test_digits_split_mask(spark):
    df = spark.createDataFrame([("12.345.678/0001-95",), (None,)], "c string")
    d = only_digits("c")
    b, o, v = cnpj_split(d)
    r = df.select(d.alias("d"), cnpj_mask(b, o, v).alias("m"), cnpj_format(d).alias("f")).collect()
    assert r[0].d == "12345678000195" and r[0].m == "12345678.0001/95" and r[0].f == "12.345.678/0001-95"
    assert r[1].d == ""
