"""Python literals read by column expressions, against ``ast.literal_eval``."""

import ast
import json
import random

from pyspark.sql import functions as F

from tracecurate.functions import literals


def as_json(value):
    """What JSON keeps of a Python value: lists for tuples, text for keys."""
    if isinstance(value, dict):
        return {k if isinstance(k, str) else {None: "null", True: "true", False: "false"}.get(k, str(k)): as_json(v) for k, v in value.items()}
    return [as_json(v) for v in value] if isinstance(value, (list, tuple)) else value


def read(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = rows.select("i", F.to_json(literals.parse_literal(F.col("t"))).alias("j")).collect()
    return [r.j and json.loads(r.j) for r in sorted(found)]


def some(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 6)
    if kind < 2:
        alphabet = "ab'\"\\\n\t\r\x07\x00\x7f é中\U0001f600{}[](),: None#"
        return "".join(rng.choice(alphabet) for _ in range(rng.randrange(12)))
    if kind < 6:
        return [None, True, False, rng.randrange(-(10**12), 10**12), rng.randrange(-999, 999) / 8, ""][rng.randrange(6)]
    if kind == 6:
        return [some(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind == 7:
        return tuple(some(rng, depth + 1) for _ in range(rng.randrange(2, 4)))
    return {some_key(rng): some(rng, depth + 1) for _ in range(rng.randrange(4))}


def some_key(rng):
    return rng.choice(["k", "a.b", "it's", 'say "x"', "", "ключ"]) + str(rng.randrange(99))


def test_random_literals(spark):
    rng = random.Random(11)
    values = [{some_key(rng): some(rng) for _ in range(rng.randrange(5))} for _ in range(400)]
    assert read(spark, [repr(v) for v in values]) == [as_json(v) for v in values]
    # ascii() spells what is not ASCII as escapes of two, four and eight digits.
    assert read(spark, [ascii(v) for v in values]) == [as_json(v) for v in values]


def test_spellings(spark):
    texts = [
        "{'a': 1,}", "{ 'a' : ( 1 , ) }", "{'n': .5, 'm': 1., 'e': 1e3, 'u': 1_000, 'p': +7}", "{5: 'one', None: 2, True: 3}",
        r"{'q': 'a\qb', 'o': '\101', 'j': 'x\
y'}", "[]", "'text'", "None", "{}", "{'a': '" + "x" * 50_000 + r"\n" * 20_000 + "'}", "{'a': \"it's\"}",
    ]
    assert read(spark, texts) == [as_json(ast.literal_eval(t)) for t in texts]


def test_what_is_no_literal_is_null(spark):
    texts = [
        "{'mlflow.trace.session': conv-1}", "{'a': 'b'", "{'a' 'b'}", "{'a': true}", "{'a': null}", "{'a': NaN}", "{'a': 'x' 'y'}", "", "   ",
        "{'a': 1 2}", "{'a': b'x'}", "{'a', 'b'}", "{'a': 'x}", "{'a': f(1)}", "not a dict", "{'a': --1}", "'", "{'a': ?}",
    ]
    assert read(spark, texts) == [None] * len(texts)
