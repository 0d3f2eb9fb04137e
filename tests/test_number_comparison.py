"""Changed fields of numbers of different types and sizes."""

import pytest

from tidelog.operators.rows import changed_fields


@pytest.mark.parametrize("old, new, changed", [
    ("90071992547409931L", "90071992547409931.25BD", True), ("90071992547409931L", "90071992547409931.000BD", False),
    ("90071992547409930L", "90071992547409931L", True), ("1.50BD", "1.5BD", False), ("100L", "100.0BD", False), ("100L", "1000L", True),
    ("1S", "1L", False), ("1L", "1.0D", False), ("0.1BD", "0.1D", False), ("0.5BD", "0.25D", True), ("'1'", "1L", True), ("'1'", "'1'", False),
    ("cast(null as int)", "0", True), ("-0.0BD", "0L", False), ("12345678901234567890.123456789012345678BD", "12345678901234567890.123456789012345679BD", True),
])
def test_values(spark, old, new, changed):
    rows = spark.sql(f"SELECT 1 AS id, map('f', cast({old} as variant)) AS before, map('f', cast({new} as variant)) AS after")
    assert changed_fields(rows).count() == int(changed)
    back = rows.selectExpr("id", "after as before", "before as after")
    assert changed_fields(back).count() == int(changed)
