"""Rows and statements into databases, by any DB-API module: one task has all of a database's rows, one transaction applies them."""

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "db string, statements long, error string"
#: Rows sent to a server at once.
CHUNK = 10_000


def _on_databases(rows: DataFrame, columns: list[str], order: list[str], connect: Callable, partitions: int, work: Callable) -> DataFrame:
    """work(connection, the database's rows as a stream) in one transaction for each database: RESULT.

    Rows reach a task sorted and are never gathered, so a database may have any number of them. A database that fails
    is rolled back and has its error; the others go on.
    """

    def run(batches):
        import itertools

        import pyarrow as pa

        def all_rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for db, group in itertools.groupby(all_rows(), key=lambda r: r[0]):
            connection, n, error = None, 0, None
            try:
                connection = connect(db)
                n = work(connection, (r[1:] for r in group))
                connection.commit()
            except Exception as e:  # any database's error is a row of the result
                n, error = 0, str(e)
                if connection is not None:
                    connection.rollback()
            finally:
                if connection is not None:
                    connection.close()
            yield pa.RecordBatch.from_arrays([pa.array([db], pa.string()), pa.array([n], pa.int64()), pa.array([error], pa.string())], names=["db", "statements", "error"])

    dealt = rows.where("db IS NOT NULL").select("db", *columns).repartition(partitions, "db").sortWithinPartitions("db", *order)
    return dealt.mapInArrow(run, RESULT)


def _chunks(rows: Iterable, size: int = CHUNK) -> Iterator[list]:
    import itertools

    rows = iter(rows)
    while part := list(itertools.islice(rows, size)):
        yield part


def insert_meta(patch: DataFrame, connect: Callable, table: str = "meta", partitions: int = 20, mark: str = "?", run: str | None = None) -> DataFrame:
    """Put db, species_id, meta_key, meta_value into the databases' meta tables where the key is absent: RESULT, with the rows inserted.

    A database's rows are staged in a temporary table by executemany and go over in one statement that leaves out known
    keys (of a key's values the least is taken; an existing one is never updated), all in one transaction. So a task or
    a run that comes again adds nothing. With ``run``, a name for this patch, the same transaction leaves a mark with
    the count in TABLE_patches, and a database that has the mark is left as it is and gives that count again. Nothing is
    done before the result is asked for.
    """
    staged, marks = f"staged_{table}", f"{table}_patches"

    def work(connection, rows):
        cursor = connection.cursor()
        if run is not None:
            cursor.execute(f"CREATE TABLE IF NOT EXISTS {marks} (run VARCHAR(190) PRIMARY KEY, inserted BIGINT)")
            cursor.execute(f"SELECT inserted FROM {marks} WHERE run = {mark}", (run,))
            if done := cursor.fetchone():
                return done[0]
        cursor.execute(f"CREATE TEMPORARY TABLE {staged} AS SELECT species_id, meta_key, meta_value FROM {table} WHERE 1 = 0")
        for part in _chunks(rows):
            cursor.executemany(f"INSERT INTO {staged} (species_id, meta_key, meta_value) VALUES ({mark}, {mark}, {mark})", part)
        known = f"SELECT 1 FROM {table} m WHERE m.meta_key = s.meta_key AND (m.species_id = s.species_id OR (m.species_id IS NULL AND s.species_id IS NULL))"
        cursor.execute(
            f"INSERT INTO {table} (species_id, meta_key, meta_value) SELECT s.species_id, s.meta_key, MIN(s.meta_value) FROM {staged} s WHERE NOT EXISTS ({known}) GROUP BY s.species_id, s.meta_key"
        )
        inserted = cursor.rowcount
        if run is not None:
            cursor.execute(f"INSERT INTO {marks} (run, inserted) VALUES ({mark}, {mark})", (run, inserted))
        return inserted

    return _on_databases(patch, ["species_id", "meta_key", "meta_value"], ["species_id", "meta_key"], connect, partitions, work)


def execute_scripts(statements: DataFrame, connect: Callable, partitions: int = 20) -> DataFrame:
    """Run db, ordinal, statement (see scripts.statements) in order, in one transaction for each database: RESULT, with the statements run.

    The connection is the database's own, so a statement that only chooses the database is left out, and empty ones too.
    """

    def work(connection, rows):
        cursor, n = connection.cursor(), 0
        for _, text in rows:
            text = text.strip().rstrip(";")
            if text and not text.upper().startswith("USE "):
                cursor.execute(text)
                n += 1
        return n

    return _on_databases(statements, ["ordinal", "statement"], ["ordinal"], connect, partitions, work)
