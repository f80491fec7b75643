"""Tables that are replaced together, and never missing while that happens.

Below ``base`` every table has a folder of versions that are written once and never
changed. Which versions are current is said by the newest manifest, a small file named by
its number. A replacement writes all new versions first and then renames a finished
manifest to the next number, which either succeeds as a whole or, where another writer
took the number, fails and is tried again on top of theirs. Readers hold on to the manifest
they read, so a table they have opened stays whole until ``vacuum`` removes versions that
no recent manifest names.
"""

import json
import uuid

from py4j.protocol import Py4JJavaError

ATTEMPTS = 20


class Snapshots:
    """The tables below a folder of any file system that Spark can write to."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base.rstrip("/")
        jvm = spark._jvm
        self._path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _numbers(self):
        folder = self._path("_manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json"))

    def _manifest(self, number):
        with_text = self.spark._jvm.org.apache.commons.io.IOUtils
        stream = self._fs.open(self._path(f"_manifests/{number}.json"))
        try:
            return json.loads(with_text.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self):
        """(number, table name -> version folder) of the newest manifest; (0, {}) before any."""
        numbers = self._numbers()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (0, {})

    def read(self, name, schema=None):
        """The current version of a table; an absent one is empty if a schema is given."""
        folder = self.current()[1].get(name)
        if folder is None:
            if schema is None:
                raise KeyError(name)
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(f"{self.base}/{folder}")

    def __contains__(self, name):
        return name in self.current()[1]

    def replace(self, tables):
        """Replace the tables name -> rows together; the others stay. Returns the number of
        the manifest. Rows may come from the tables that are replaced."""
        fresh = {}
        for name, rows in tables.items():
            fresh[name] = f"{name}/{uuid.uuid4().hex}"
            rows.write.parquet(f"{self.base}/{fresh[name]}")
        for _ in range(ATTEMPTS):
            number, known = self.current()
            if self._commit(number + 1, {**known, **fresh}):
                return number + 1
        raise OSError(f"{self.base}: other writers took the number {ATTEMPTS} times")

    def _commit(self, number, manifest):
        draft, target = self._path(f"_drafts/{uuid.uuid4().hex}"), self._path(f"_manifests/{number}.json")
        self._fs.mkdirs(self._path("_manifests"))
        out = self._fs.create(draft, False)
        out.write(json.dumps(manifest).encode())
        out.close()
        files = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        none = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        try:
            files.rename(draft, target, options)  # fails where the target is there
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            self._fs.delete(draft, False)
            return False

    def vacuum(self, keep=2):
        """Remove the versions that none of the last ``keep`` manifests names, and older
        manifests. Writers and readers of older ones must have ended. Returns the folders removed."""
        numbers = self._numbers()
        named = {folder for n in numbers[-keep:] for folder in self._manifest(n).values()}
        gone = []
        for number in numbers[:-keep]:
            gone += [f for f in self._manifest(number).values() if f not in named and f not in gone]
            self._fs.delete(self._path(f"_manifests/{number}.json"), False)
        for folder in gone:
            self._fs.delete(self._path(folder), True)
        return gone
