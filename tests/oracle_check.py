"""Compare bound queries with their SQL in DuckDB.

python tests/oracle_check.py [sf-dir] [name ...]
"""

import math
import pathlib
import shutil
import sys
import tempfile
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def cell(x):
    if x is None:
        return "~"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    if isinstance(x, int):
        return f"{float(x):.9g}" if abs(x) < 2**52 else str(x)
    return str(x)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def family(t):
    t = str(t).lower()
    for name, hits in (("int", ("int", "long")), ("float", ("double", "float")),
                       ("text", ("varchar", "string")), ("bool", ("bool",))):
        if any(h in t for h in hits) and "(" not in t:
            return name
    return t


def compare(df, con, sql):
    """None if equal, else what differs."""
    types = {d[0]: family(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {f.name: family(f.dataType.simpleString()) for f in df.schema}
    if types != mine:
        return f"types {[(k, v, types.get(k)) for k, v in mine.items() if types.get(k) != v]}"
    got = table(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want = table([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    extra = [r for r in got[1] if r not in set(want[1])][:3]
    missing = [r for r in want[1] if r not in set(got[1])][:3]
    return f"rows {len(got[1])} vs {len(want[1])}; spark only {extra}; sql only {missing}"


def main():
    import __spark_entry__ as e
    from pyspark.sql import SparkSession
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="oracle-")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.checkpoint.dir", f"file://{scratch}/shared")
             .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf), e.oracle_sql(), 0
    for name, q in e.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        t = time.time()
        try:
            if name in sqls:
                diff = compare(q(spark, sf), con, sqls[name])
            else:
                diff = None if q(spark, sf).count() else "no rows"
        except Exception as ex:  # noqa: BLE001
            diff = f"{type(ex).__name__}: {str(ex)[:700]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - t:.1f}s"
              f"{'' if name in sqls else ' (rows only)'}{'' if diff is None else ' ' + diff}", flush=True)
    print("bad:", bad)
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)


if __name__ == "__main__":
    main()
