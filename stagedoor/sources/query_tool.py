"""Command line for one read-only query: ``python -m stagedoor.sources.query_tool DIR "SQL"``.

Prints a line of names and one for each row, fields between tabs. Exit status 2 without a query, 1 without tables or on a failing query.
"""

import sys

from pyspark.errors import PySparkException

from stagedoor.session import build_session, list_names
from stagedoor.sources.files import adhoc_sql, register_tables


def main(arguments: list[str]) -> int:
    if len(arguments) < 2 or not arguments[1].strip():
        print('usage: query_tool WAREHOUSE_DIR "SELECT ..."', file=sys.stderr)
        return 2
    warehouse, text = arguments[0], arguments[1]
    spark = build_session("stagedoor-query")
    names = [n for n in list_names(spark, warehouse) if not n.startswith(("_", "."))]
    if not names:
        print(f"no tables at {warehouse}; run a refresh first", file=sys.stderr)
        return 1
    try:
        register_tables(spark, warehouse, names)
        result = adhoc_sql(spark, text)
        print("\t".join(result.columns))
        # A partition at a time, however many rows there are.
        for row in result.toLocalIterator():
            print("\t".join("NULL" if v is None else str(v) for v in row))
    except PySparkException as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
