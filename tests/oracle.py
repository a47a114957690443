"""Compare a registered query with its SQL twin."""

import datetime
import math
from collections import Counter

import duckdb

SMALL = "/root/testdata/sf0.001"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql):
    """Empty text when names, types and rows agree, else what differs."""
    cursor = con.execute(sql)
    wanted_types = {d[0]: str(d[1]) for d in cursor.description}
    wanted_rows = cursor.fetchall()
    wanted_names = list(wanted_types)
    if sorted(df.columns) != sorted(wanted_names):
        return f"columns {sorted(df.columns)} / {sorted(wanted_names)}"
    types = {f.name: SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    uneven = {n: (types[n], wanted_types[n]) for n in types if types[n] != wanted_types[n]}
    if uneven:
        return f"types {uneven}"
    names = sorted(df.columns)
    place = [wanted_names.index(n) for n in names]
    wanted = Counter(tuple(plain(row[i]) for i in place) for row in wanted_rows)
    position = [df.columns.index(n) for n in names]
    found = Counter(tuple(plain(row[i]) for i in position) for row in df.collect())
    if found == wanted:
        return ""
    extra, absent = list((found - wanted).items())[:3], list((wanted - found).items())[:3]
    return f"rows {sum(found.values())} / {sum(wanted.values())}; extra {extra}; absent {absent}"
