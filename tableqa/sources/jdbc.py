"""Reading a database over JDBC: options, connection aliases, partitioned reads, the change-table query."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

# Fixed values of the server connection.
PORT = 1433
PACKET_SIZE = 512
FETCH_SIZE = 100_000


def jdbc_options(config: dict) -> dict[str, str]:
    """Reader options from a config with server, database and, unless the driver signs in by itself, username and
    password. `url` overrides the address; `driver` names the JDBC class; `login_timeout` and `query_timeout` are
    seconds."""
    if "url" in config:
        url = config["url"]
    else:
        url = (
            f"jdbc:sqlserver://{config['server']}:{config.get('port', PORT)};databaseName={config['database']};"
            f"encrypt=true;trustServerCertificate=true;packetSize={PACKET_SIZE}"
        )
    options = {"url": url}
    for key, option in (
        ("username", "user"), ("password", "password"), ("driver", "driver"),
        ("login_timeout", "loginTimeout"), ("query_timeout", "queryTimeout"),
    ):
        if config.get(key):
            options[option] = str(config[key])
    return options


def resolve_connection(
    config: dict | None = None,
    connection_name: str | None = None,
    aliases: dict[str, dict] | None = None,
) -> dict[str, str]:
    """Options from a config or, failing that, from a named alias of the caller's table."""
    if config:
        return jdbc_options(config)
    if connection_name:
        if connection_name not in (aliases or {}):
            raise ValueError(f"unknown connection name: {connection_name}")
        return jdbc_options(aliases[connection_name])
    raise ValueError("give either a connection config or a connection name")


def tsql_ident(name: str) -> str:
    return "[" + name.replace("]", "]]") + "]"


def table_query(schema: str, table: str) -> str:
    return f"SELECT * FROM {tsql_ident(schema)}.{tsql_ident(table)}"


def change_query(schema: str, table: str, primary_key: str, min_version: int = 0) -> str:
    """Tracked changes newer than a version, evaluated by the server."""
    return (
        f"SELECT c.{tsql_ident(primary_key)}, c.SYS_CHANGE_VERSION AS sys_change_version, "
        f"c.SYS_CHANGE_OPERATION AS sys_change_operation "
        f"FROM CHANGETABLE(CHANGES {tsql_ident(schema)}.{tsql_ident(table)}, {int(min_version)}) AS c"
    )


def change_rows_query(schema: str, table: str, primary_key: str, columns: list[str], min_version: int = 0) -> str:
    """Tracked changes newer than a version with the current row of their key, joined by the server: only the changed
    rows travel. The key comes from the change, so it is known for deleted rows; `columns` are those of the table."""
    key = tsql_ident(primary_key)
    values = [f"c.{key}" if c == primary_key else f"b.{tsql_ident(c)}" for c in columns]
    return (
        f"SELECT {', '.join(values)}, c.SYS_CHANGE_VERSION AS sys_change_version, c.SYS_CHANGE_OPERATION AS "
        f"sys_change_operation FROM CHANGETABLE(CHANGES {tsql_ident(schema)}.{tsql_ident(table)}, {int(min_version)}) AS c "
        f"LEFT JOIN {tsql_ident(schema)}.{tsql_ident(table)} AS b ON b.{key} = c.{key}"
    )


def jdbc_reader(
    spark: SparkSession,
    options: dict[str, str],
    query: str | None = None,
    schema: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    lower_bound=None,
    upper_bound=None,
    num_partitions: int | None = None,
    fetch_size: int = FETCH_SIZE,
) -> DataFrameReader:
    """Configured reader. With a partition column the server is read by `num_partitions` tasks, each with its own
    range predicate; the first and last range are open, so no row is lost outside the bounds."""
    if query is None and table is None:
        raise ValueError("give a table or a query")
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", fetch_size)
    if partition_column is None:
        return reader.option("query", query or table_query(schema, table))
    if None in (lower_bound, upper_bound, num_partitions):
        raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
    source = f"({query}) AS src" if query else f"{tsql_ident(schema)}.{tsql_ident(table)}"
    return (
        reader.option("dbtable", source)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower_bound)
        .option("upperBound", upper_bound)
        .option("numPartitions", num_partitions)
    )


def read_jdbc(spark: SparkSession, options: dict[str, str], **arguments) -> DataFrame:
    return jdbc_reader(spark, options, **arguments).load()


def bounds_query(source: str, column: str) -> str:
    """Smallest and largest value of a column, found by the server."""
    name = tsql_ident(column)
    return f"SELECT MIN({name}) AS lower_bound, MAX({name}) AS upper_bound FROM ({source}) AS src"


def read_jdbc_split(
    spark: SparkSession,
    options: dict[str, str],
    column: str,
    num_partitions: int,
    query: str | None = None,
    schema: str | None = None,
    table: str | None = None,
    fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """Read a table or query by `num_partitions` tasks, each with a range of a numeric or time column. NULLs go with
    the first range. The key column of a table is the natural choice; no row is read twice."""
    source = query or table_query(schema, table)
    bounds = read_jdbc(spark, options, query=bounds_query(source, column)).first()
    split = {}
    if bounds.lower_bound is not None:
        split = {
            "partition_column": column, "lower_bound": str(bounds.lower_bound), "upper_bound": str(bounds.upper_bound),
            "num_partitions": num_partitions,
        }
    return read_jdbc(spark, options, query=query, schema=schema, table=table, fetch_size=fetch_size, **split)


def read_jdbc_batches(
    spark: SparkSession, options: dict[str, str], source: str, predicates: list[str], fetch_size: int = FETCH_SIZE
) -> DataFrame:
    """Read by one task per predicate of the caller, which must cover every row once."""
    properties = {k: v for k, v in options.items() if k != "url"} | {"fetchsize": str(fetch_size)}
    return spark.read.jdbc(options["url"], source, predicates=predicates, properties=properties)


def quantile_query(source: str, column: str, parts: int) -> str:
    """Smallest value of each of `parts` equally large groups of rows, found by the server."""
    name = tsql_ident(column)
    return (
        f"SELECT MIN({name}) AS bound FROM (SELECT {name}, NTILE({int(parts)}) OVER (ORDER BY {name}) AS part "
        f"FROM ({source}) AS src WHERE {name} IS NOT NULL) AS parts GROUP BY part"
    )


def range_predicates(column: str, bounds: list) -> list[str]:
    """Predicates that together cover every row once: up to the second bound and NULL, between bounds, from the last on.
    A value that fills several groups gives one range."""
    name = tsql_ident(column)

    def literal(value) -> str:
        return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"

    inner = [literal(b) for b in sorted(set(bounds))[1:]]
    if not inner:
        return ["1 = 1"]
    between = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(inner, inner[1:])]
    return [f"{name} < {inner[0]} OR {name} IS NULL", *between, f"{name} >= {inner[-1]}"]


def read_jdbc_balanced(
    spark: SparkSession, options: dict[str, str], column: str, num_partitions: int, query: str | None = None,
    schema: str | None = None, table: str | None = None, fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """As read_jdbc_split, but with ranges of about equal numbers of rows, whatever the distribution of the column."""
    source = query or table_query(schema, table)
    bounds = read_jdbc(spark, options, query=quantile_query(source, column, num_partitions)).collect()
    predicates = range_predicates(column, [r.bound for r in bounds])
    return read_jdbc_batches(spark, options, f"({source}) AS src", predicates, fetch_size)
