"""Key and value metadata of databases."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull

from .. import constants, schemas
from ..session import ship, stored


def read_meta(spark: SparkSession, path: str, keys: list[str] = constants.ENRICHMENT_KEYS) -> DataFrame:
    """db, species_id, meta_key, meta_value of a table that holds the metadata of all databases; only the keys wanted are read."""
    return spark.read.schema(schemas.META).parquet(path).where(F.col("meta_key").isin(keys))


class MetaReader(DataSourceReader):
    """Reads the meta tables of the databases that a folder of Parquet files names; one partition a file.

    Filters that hold db or meta_key against values are taken over: of the names only those wanted are opened, and keys
    become part of the query that the servers get. Names are read in tasks, never by the driver.
    """

    def __init__(self, options, connect: Callable, mark: str, table: str):
        self.names, self.connect, self.mark, self.table = options["names"], connect, mark, table
        self.wanted: dict = {"db": None, "meta_key": None}

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if name in self.wanted and values is not None:
                self.wanted[name] = values if self.wanted[name] is None else self.wanted[name] & values
            elif name != "db" or not isinstance(f, IsNotNull):
                yield f

    def partitions(self):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.names)
        return [InputPartition(f.path) for f in system.get_file_info(fs.FileSelector(base, recursive=True)) if f.path.endswith(".parquet")]

    def statement(self) -> tuple[str, tuple]:
        keys = self.wanted["meta_key"]
        where = "" if keys is None else f" WHERE meta_key IN ({', '.join([self.mark] * len(keys))})" if keys else " WHERE 1 = 0"
        return f"SELECT species_id, meta_key, meta_value FROM {self.table}{where}", tuple(sorted(keys or ()))

    def read(self, partition):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(self.names)
        query, parameters = self.statement()
        for batch in pq.ParquetFile(system.open_input_file(partition.value)).iter_batches(columns=["db"]):
            for db in batch.column(0).to_pylist():
                if self.wanted["db"] is not None and db not in self.wanted["db"]:
                    continue
                connection = self.connect(db)
                try:
                    cursor = connection.cursor()
                    cursor.execute(query, parameters)
                    while rows := cursor.fetchmany(10_000):
                        ids, found, values = zip(*rows)
                        yield pa.RecordBatch.from_arrays([pa.array([db] * len(rows), pa.string()), pa.array(ids, pa.int32()), pa.array(found, pa.string()), pa.array(values, pa.string())], names=["db", "species_id", "meta_key", "meta_value"])
                finally:
                    connection.close()


def meta_source(connect: Callable, mark: str = "?", table: str = "meta") -> type[DataSource]:
    """The format "meta_databases" for databases that connect(db) opens with a DB-API module; mark is its sign for a parameter."""

    class MetaSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "meta_databases"

        def schema(self) -> str:
            return schemas.META

        def reader(self, schema) -> DataSourceReader:
            return MetaReader(self.options, connect, mark, table)

    return MetaSource


def read_meta_databases(names: DataFrame, connect: Callable, keys: list[str] | None = constants.ENRICHMENT_KEYS, partitions: int = 20, mark: str = "?") -> DataFrame:
    """db, species_id, meta_key, meta_value from the meta tables of many databases: one plan whatever their number.

    names: a column db; it is written to the shared folder in ``partitions`` files, each of which is a task, so no more
    connections are open at a time. connect(db) runs in the task. A reader opens each database once; who uses the frame
    more than once stores it (the run does). keys None: all keys.
    """
    spark = ship(names.sparkSession)
    wanted = stored(names.select("db").where("db IS NOT NULL").distinct().repartition(partitions, "db"), "database-names")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(meta_source(connect, mark))
    rows = spark.read.format("meta_databases").option("names", wanted.inputFiles()[0].rsplit("/", 1)[0] if wanted.inputFiles() else "").load()
    return rows if keys is None else rows.where(F.col("meta_key").isin(keys))
