"""The driver contract: names, flagship, and that every query and check is well-formed."""

import re

import __spark_entry__ as contract


def test_registry():
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) >= 100
    # every inventory row is there
    found = {m.group() for name in queries if (m := re.match(r"[a-z]\d\d(?=_)", name))}
    wanted = {
        *[f"s{i:02}" for i in range(1, 6)], *[f"v{i:02}" for i in range(1, 8)],
        *[f"e{i:02}" for i in range(1, 5)], *[f"c{i:02}" for i in range(1, 9)],
        *[f"a{i:02}" for i in range(1, 6)], *[f"p{i:02}" for i in range(1, 7)],
        *[f"f{i:02}" for i in range(1, 13)], *[f"r{i:02}" for i in range(1, 10)],
        *[f"m{i:02}" for i in range(1, 18)], *[f"x{i:02}" for i in range(1, 5)], "j01", "j02",
    }
    assert found == wanted


def test_flagship(spark):
    row = contract.entry(spark).first()
    assert row["n_test_samples"] == 375 and row["n_train_samples"] == 1125
