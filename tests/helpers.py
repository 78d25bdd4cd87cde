"""Small literal series."""

LAYOUT = "id, uri, t, v, upperbound, lowerbound, amp, switch_default, seq"


def series(spark, rows, upper="10", lower="0", amp="0.5", default="1", first_seq=0):
    """``rows`` are ``(point, t, v)`` in order of arrival."""
    values = ", ".join(
        f"('/g/{p}', '/u/{p}', CAST({t} AS BIGINT), CAST({v} AS DOUBLE), '{upper}', '{lower}', '{amp}', '{default}', "
        f"CAST({first_seq + n} AS BIGINT))"
        for n, (p, t, v) in enumerate(rows)
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS s({LAYOUT})")


def parse(point, text):
    """``"1:10 2:8"`` -> rows of one point."""
    return [(point, *map(float_or_int, item.split(":"))) for item in text.split()]


def float_or_int(x):
    return float(x) if "." in x else int(x)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
