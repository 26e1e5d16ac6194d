"""Sessions: connections over one or several databases, parameters, statements and bulk inserts.

Statements are Spark SQL; there is no parser of another dialect here. Each connection is a Spark
session of its own, with its own views and settings; functions registered on one connection of a
database are known on all.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .result import Result, translated
from .sources.appender import Appender

_WRITES = ("insert", "update", "delete", "merge", "create", "drop", "alter", "truncate", "load", "refresh", "msck", "repair")
#: Strings, quoted names and comments, which hold no words or parameters of the statement.
_QUOTED = re.compile(r"(?s)'(?:[^'\\]|''|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/")
_INSERT = re.compile(r"(?is)^\s*insert\s+(into|overwrite)\s+(?:table\s+)?([\w.`]+)")
_ROWS = re.compile(r"(?is)^\s*insert\s+into\s+(?:table\s+)?([\w.`]+)\s*(?:\(([^()]*)\))?\s*values\s*\(\s*\?(?:\s*,\s*\?)*\s*\)\s*;?\s*$")
_KINDS = ("select", "with", "values", "insert", "update", "delete", "merge", "create", "drop", "alter", "truncate", "set", "explain", "describe", "show", "use", "cache", "analyze")
OPTIONS = {
    "threads": "spark.sql.shuffle.partitions",
    "broadcast_limit": "spark.sql.autoBroadcastJoinThreshold",
    "timezone": "spark.sql.session.timeZone",
    "adaptive": "spark.sql.adaptive.enabled",
    "access_mode": None,
}


class Config:
    """Settings by name; an unknown name or value raises at once."""

    def __init__(self, values: Mapping[str, Any] | None = None):
        self.values: dict[str, str] = {}
        for k, v in (values or {}).items():
            self.set(k, v)

    @staticmethod
    def available_options() -> list[str]:
        return sorted(OPTIONS)

    def set(self, name: str, value: Any) -> Config:
        if name not in OPTIONS:
            raise ValueError(f"unknown option {name!r}; there are {', '.join(self.available_options())}")
        value = str(value)
        if name == "threads" and not (value.isdigit() and int(value) > 0):
            raise ValueError("threads must be a positive number")
        if name == "access_mode" and value.upper() not in ("READ_ONLY", "READ_WRITE"):
            raise ValueError("access_mode must be READ_ONLY or READ_WRITE")
        self.values[name] = value.upper() if name == "access_mode" else value
        return self


class Database:
    """What connections share: the Spark application, and the functions registered on any of them."""

    def __init__(self, spark: SparkSession | None = None):
        self.spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        self.functions: dict[str, Callable[[SparkSession], None]] = {}
        self.sessions: list[SparkSession] = []

    def connect(self, config: Config | None = None) -> Connection:
        return Connection(self, config)

    def register(self, name: str, install: Callable[[SparkSession], None]) -> None:
        self.functions[name] = install
        for s in self.sessions:
            install(s)


def bare(sql: str) -> str:
    """The statement with blanks in place of strings, quoted names and comments, so that places stay the same."""
    return _QUOTED.sub(lambda m: " " * len(m[0]), sql)


def main_words(sql: str) -> list[str]:
    """The words outside of parentheses that may name what a statement does: the first, and after WITH or FROM all further ones."""
    depth, words = 0, []
    for m in re.finditer(r"[()]|[A-Za-z_]\w*", bare(sql)):
        depth += {"(": 1, ")": -1}.get(m[0], 0)
        if depth == 0 and m[0] not in "()":
            words.append(m[0].lower())
    return words if words[:1] in (["with"], ["from"]) else words[:1]


def statement_type(sql: str) -> str:
    """The kind of a statement: its first word, or what follows common table expressions; 'invalid' if that is none."""
    words = main_words(sql)
    if words[:1] in (["with"], ["from"]):
        return next((w for w in words if w in _WRITES), "select")
    found = words[0] if words else "select" if bare(sql).lstrip().startswith("(") else ""
    return {"values": "select"}.get(found, found) if found in _KINDS else "invalid"


def quote_name(name: str) -> str:
    """A name as it stands in SQL, whatever letters it has."""
    return "`" + name.replace("`", "``") + "`"


def quote_text(text: str) -> str:
    """A string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_colons(sql: str) -> str:
    """$1 and $name as :_1 and :name; strings, quoted names and comments stay as they are."""
    plain, out, at = bare(sql), [], 0
    for m in re.finditer(r"\$(\w+)", plain):
        out += [sql[at : m.start()], ":_" if m[1].isdigit() else ":", m[1]]
        at = m.end()
    return "".join([*out, sql[at:]])


class Connection:
    def __init__(self, database: Database, config: Config | None = None):
        self.database, self.config = database, config or Config()
        self.spark = database.spark.newSession()
        for name, value in self.config.values.items():
            if OPTIONS[name]:
                self.spark.conf.set(OPTIONS[name], value)
        self.read_only = self.config.values.get("access_mode") == "READ_ONLY"
        database.sessions.append(self.spark)
        for install in database.functions.values():
            install(self.spark)

    def setting(self, name: str) -> str | None:
        key = OPTIONS[name]
        return self.spark.conf.get(key) if key else self.config.values.get(name)

    def execute(self, sql: str, parameters: Sequence[Any] | Mapping[str, Any] | None = None) -> Result:
        """One statement, with ? or $1 and a sequence, or :name or $name and a mapping. Commands run at once, queries when rows are fetched."""
        kind = statement_type(sql)
        if self.read_only and (kind in _WRITES or main_words(sql)[:1] and main_words(sql)[0] in _WRITES):
            raise PermissionError("the connection is read-only")
        args = dict(parameters) if isinstance(parameters, Mapping) else list(parameters) if parameters is not None else None
        if "$" in bare(sql):
            sql = with_colons(sql)
            args = {f"_{i}": v for i, v in enumerate(args, 1)} if isinstance(args, list) else args
        with translated():
            count = self._counter(sql) if kind == "insert" else None
            result = Result(self.spark.sql(sql, args=args) if args is not None else self.spark.sql(sql), kind)
            result.rows_changed = count() if count else 0
            return result

    def _counter(self, sql: str) -> Callable[[], int] | None:
        """Gives the rows that an INSERT adds, from the table's row counts, which columnar files have in their footers."""
        if not (m := _INSERT.match(bare(sql))) or not self.spark.catalog.tableExists(name := sql[m.start(2) : m.end(2)]):
            return None
        before = self.spark.table(name).count() if m[1].lower() == "into" else 0
        return lambda: self.spark.table(name).count() - before

    sql = execute

    def prepare(self, sql: str) -> Prepared:
        return Prepared(self, sql)

    def executemany(self, sql: str, rows: Iterable[Sequence[Any] | Mapping[str, Any]]) -> int:
        """The statement for each row of parameters, results discarded. INSERT INTO ... VALUES (?, ...) loads all rows at once."""
        if (m := _ROWS.match(sql)) and not self.read_only and self.spark.catalog.tableExists(m[1]):
            rows = list(rows)
            fields = {f.name.lower(): f for f in self.spark.table(m[1]).schema}
            names = [x.strip().strip("`").lower() for x in m[2].split(",")] if m[2] else list(fields)
            if all(n in fields for n in names) and all(not isinstance(r, Mapping) and len(r) == len(names) for r in rows):
                with translated(), Appender(self.spark, m[1]) as load:
                    load.append_rows([dict(zip(names, r, strict=True)).get(n) for n in fields] for r in rows)
                return len(rows)
        n = 0
        for n, row in enumerate(rows, 1):  # noqa: B007
            self.execute(sql, row)
        return n

    def register(self, name: str, function) -> None:
        """A scalar function for SQL on all connections of the database."""
        self.database.register(name, lambda s: s.udf.register(name, function) and None)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def read_csv(self, path: str) -> Result:
        return Result(self.spark.read.option("timestampType", "TIMESTAMP_NTZ").csv(path, header=True, inferSchema=True))

    def read_parquet(self, path: str) -> Result:
        return Result(self.spark.read.parquet(path))

    def read_json(self, path: str, multiline: bool = False) -> Result:
        return Result(self.spark.read.json(path, multiLine=multiline))

    def update(self, name: str, values: Mapping[str, str], where: str = "true") -> int:
        """UPDATE of a table without transactions: it is written anew beside the old one, then renamed. Gives the rows changed."""
        return self._rewrite(name, where, values)

    def delete(self, name: str, where: str = "true") -> int:
        """DELETE in the same way; rows for which the condition is null stay."""
        return self._rewrite(name, where, None)

    def _rewrite(self, name: str, where: str, values: Mapping[str, str] | None) -> int:
        """The new rows go to a table like the old one; the two change names, and only then the old one is dropped, so that the rows are in one of them at any time."""
        from pyspark.sql import functions as F

        if self.read_only:
            raise PermissionError("the connection is read-only")
        with translated():
            rows, hit = self.spark.table(name), F.coalesce(F.expr(where), F.lit(False))
            if unknown := set(values or ()) - set(rows.columns):
                raise ValueError(f"{name} has no columns {sorted(unknown)}")
            n = rows.where(hit).count()
            if n == 0:
                return 0
            new = rows.where(~hit) if values is None else rows.select(*[F.when(hit, F.expr(values[c]).cast(rows.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in rows.columns])
            self.spark.sql(f"CREATE TABLE {name}__new LIKE {name}")
            new.write.mode("append").insertInto(f"{name}__new")
            self.spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
            self.spark.sql(f"ALTER TABLE {name}__new RENAME TO {name}")
            self.spark.sql(f"DROP TABLE {name}__old")
        return n

    def close(self) -> None:
        if self.spark in self.database.sessions:
            self.database.sessions.remove(self.spark)

    def __enter__(self) -> Connection:
        return self

    def __exit__(self, *_) -> None:
        self.close()


class Prepared:
    """A statement kept with its parameters; Spark plans it anew at each execution."""

    def __init__(self, connection: Connection, sql: str):
        self.connection, self.sql, self.values = connection, with_colons(sql), {}
        plain = bare(with_colons(sql))
        self.names = list(dict.fromkeys(re.findall(r"(?<!:):([A-Za-z_]\w*)", plain)))
        self.count = plain.count("?") or len(self.names)
        if statement_type(sql) == "invalid":
            raise ValueError("not a statement")
        if statement_type(sql) == "select":
            with translated():
                connection.spark.sql(self.sql, args={n: None for n in self.names} if self.names else [None] * self.count or None)

    def index(self, name: str) -> int:
        """The place of a named parameter, from 1."""
        return self.names.index(name) + 1

    def bind(self, parameter: int | str, value: Any) -> Prepared:
        """By name, or by place from 1; $1 has the place 1."""
        if isinstance(parameter, int) and f"_{parameter}" in self.names:
            parameter = f"_{parameter}"
        known = parameter in self.names if isinstance(parameter, str) else 1 <= parameter <= self.count
        if not known:
            raise KeyError(parameter)
        self.values[parameter] = value
        return self

    def clear(self) -> None:
        self.values = {}

    def execute(self) -> Result:
        missing = set(self.names or range(1, self.count + 1)) - self.values.keys()
        if missing:
            raise ValueError(f"parameters without a value: {sorted(missing)}")
        args = dict(self.values) if self.names else [self.values[i] for i in range(1, self.count + 1)]
        return self.connection.execute(self.sql, args or None)


_default: list[Connection] = []


def connect(read_only: bool = False, config: Config | Mapping[str, Any] | None = None, database: Database | None = None) -> Connection:
    config = config if isinstance(config, Config) else Config(config)
    if read_only:
        config.set("access_mode", "READ_ONLY")
    return Connection(database or Database(), config)


def default_connection() -> Connection:
    """One per process, made on first use."""
    if not _default:
        _default.append(connect())
    return _default[0]


def sql(text: str, parameters=None) -> Result:
    return default_connection().execute(text, parameters)


execute = sql


def read_csv(path: str) -> Result:
    return default_connection().read_csv(path)


def read_parquet(path: str) -> Result:
    return default_connection().read_parquet(path)


def read_json(path: str, multiline: bool = False) -> Result:
    return default_connection().read_json(path, multiline)
