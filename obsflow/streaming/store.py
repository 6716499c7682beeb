"""Results by batch, and tables that batches change in place of their keys."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsflow.operators.windows import same_keys


class BatchStore:
    """A folder of ``batch_id=N`` folders.

    A restarted query repeats its last batch; writing that batch's folder anew
    leaves exactly one copy of its rows.
    """

    def __init__(self, spark, path, format="parquet", header=True):
        self.spark = spark
        self.path = path
        self.format = format
        self.options = {"header": str(header).lower()} if format == "csv" else {}

    def folder(self, batch_id):
        """Where a batch's rows are."""
        return f"{self.path}/batch_id={batch_id}"

    def write(self, df, batch_id):
        """Replace the rows of a batch."""
        df.write.format(self.format).options(**self.options).mode("overwrite").save(self.folder(batch_id))

    def batches(self):
        """Numbers of the batches written whole."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        found = []
        for status in system.listStatus(root):
            match = re.fullmatch(r"batch_id=(\d+)", status.getPath().getName())
            if match and system.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
                found.append(int(match.group(1)))
        return sorted(found)

    def written(self, batch_id):
        """Whether a batch was written whole."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        mark = hadoop.Path(self.folder(batch_id), "_SUCCESS")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def latest(self, before=None):
        """Number of the last batch, or the last before another; None if there is none.

        The batch just before another is looked for by name; only without it are folders listed.
        """
        if before is not None and before > 0 and self.written(before - 1):
            return before - 1
        numbers = [n for n in self.batches() if before is None or n < before]
        return numbers[-1] if numbers else None

    def read(self, batch_id=None):
        """Rows of one batch, or of all with their ``batch_id``."""
        reader = self.spark.read.format(self.format).options(**self.options)
        if self.format == "csv":
            reader = reader.option("inferSchema", "false")
        return reader.load(self.path if batch_id is None else self.folder(batch_id))

    def forget(self, keep):
        """Delete all but the last ``keep`` batches; for tables rewritten whole each time."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for number in self.batches()[:-keep]:
            folder = hadoop.Path(self.folder(number))
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


class KeyedTable:
    """A table by key and partition that batches of changed rows update.

    A batch writes anew only the partitions it has rows for, each to a folder named after the
    batch, and then replaces the manifest, one small file that names the folder of every
    partition. Readers open the manifest and the folders it names: they list nothing and never see half
    a batch. A batch that runs again changes nothing once its manifest is there, and
    writes the same folders before. Replaced folders stay for ``keep`` further batches,
    for readers of an older manifest.
    """

    def __init__(self, spark, path, keys, partition, keep=3):
        self.spark, self.path, self.keys, self.partition, self.keep = spark, path, list(keys), partition, keep
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, name):
        return self._fs.Path(f"{self.path}/{name}")

    def manifest(self):
        """``batch_id``, ``schema``, ``folders`` by partition and ``replaced`` folders; None before the first batch."""
        at = self._path("manifest.json")
        system = at.getFileSystem(self._conf)
        if not system.exists(at):
            return None
        opened = system.open(at)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()
        return json.loads(text)

    def _publish(self, manifest):
        """Replace the manifest in one step."""
        fresh, at = self._path(f"manifest-{manifest['batch_id']}.tmp"), self._path("manifest.json")
        stream = fresh.getFileSystem(self._conf).create(fresh, True)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm
        rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._fs.FileContext.getFileContext(at.toUri(), self._conf).rename(fresh, at, options)

    def update(self, rows, batch_id):
        """Put each row in place of the row with its key. Rows of one batch have distinct keys."""
        now = self.manifest() or {"batch_id": -1, "schema": None, "folders": {}, "replaced": []}
        if now["batch_id"] >= batch_id:
            return
        text = F.coalesce(F.col(self.partition).cast("string"), F.lit("null"))
        rows = rows.persist()
        try:
            # One name per partition of the batch: what the manifest will hold anyway.
            touched = sorted(r[0] for r in rows.select(text).distinct().collect())
            if touched:
                old = [now["folders"][p] for p in touched if p in now["folders"]]
                whole = rows
                if old:
                    before = self._read(old, rows.schema)
                    whole = before.alias("o").join(rows.alias("n"), same_keys("o", "n", self.keys), "left_anti").unionByName(rows)
                folder = f"batch={batch_id}"
                whole = whole.withColumn("_part", text).repartition("_part")
                whole.write.partitionBy("_part").mode("overwrite").parquet(f"{self.path}/{folder}")
                names = dict(zip(touched, self._names(rows.sparkSession, touched)))
                now["replaced"] += [[batch_id, f] for f in old]
                now["folders"].update({p: f"{folder}/_part={names[p]}" for p in touched})
                now["schema"] = rows.schema.json()
        finally:
            rows.unpersist()
        gone = [f for b, f in now["replaced"] if b <= batch_id - self.keep]
        now["replaced"] = [[b, f] for b, f in now["replaced"] if b > batch_id - self.keep]
        now["batch_id"] = batch_id
        self._publish(now)
        for name in gone:
            folder = self._path(name)
            folder.getFileSystem(self._conf).delete(folder, True)

    @staticmethod
    def _names(spark, parts):
        """Partition values as Spark writes them in folder names."""
        escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return [escape(p) for p in parts]

    def _read(self, folders, schema):
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self):
        """All rows as the last whole batch left them; None before the first batch with rows."""
        now = self.manifest()
        if not now or not now["folders"]:
            return None
        return self._read(sorted(now["folders"].values()), StructType.fromJson(json.loads(now["schema"])))
