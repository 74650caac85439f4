"""A log of numbered entries that any number of processes extend at once without a lock."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from cohortlake.session import folder_of


class CommitLog:
    """Entries 1, 2, 3 ... below ``folder``, one small JSON file each; the newest one is the state.

    A writer reads the newest entry, makes its successor and commits that under the next number. The file is
    written out of sight and gets its name in one step that fails if the name is taken (a link on a local
    file system, a rename without overwriting elsewhere; both are atomic on file systems and on HDFS). Who
    finds the number taken looks at the new state and tries again, so no entry is built on a state that was
    not the newest, none is lost, and a writer that dies leaves nothing that others wait for.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def head(self) -> tuple[int, dict[str, Any] | None]:
        """Number and content of the newest entry; 0 and None where there is none."""
        files, folder = folder_of(self.spark, self.folder)
        if not files.exists(folder):
            return 0, None
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        number = max((int(n.split(".")[0]) for n in names if n[0].isdigit()), default=0)
        return number, self._read(number) if number else None

    def entries(self) -> list[dict[str, Any]]:
        """All entries in order."""
        return [self._read(n) for n in range(1, self.head()[0] + 1)]

    def try_append(self, number: int, entry: dict[str, Any]) -> bool:
        """Commit ``entry`` under ``number``; False if another writer has taken it."""
        files, hidden = folder_of(self.spark, f"{self.folder}/_new/{uuid.uuid4().hex}.json")
        _, shown = folder_of(self.spark, self._name(number))
        out = files.create(hidden, False)
        out.write(bytearray(json.dumps(entry, ensure_ascii=False, default=str).encode()))
        out.close()
        try:
            self._name_once(files, hidden, shown)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName() or files.exists(shown):
                return False
            raise
        finally:
            files.delete(hidden, False)

    def update(
        self, change: Callable[[dict[str, Any] | None], dict[str, Any] | None]
    ) -> tuple[dict[str, Any] | None, dict[str, Any] | None]:
        """Commit what ``change`` makes of the newest entry, and return that entry and its successor.

        ``change`` runs again whenever another writer was faster; None from it leaves the log as it is.
        """
        while True:
            number, before = self.head()
            after = change(before)
            if after is None or self.try_append(number + 1, after):
                return before, after

    def _name(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def _name_once(self, files, hidden, shown) -> None:
        jvm = self.spark._jvm
        if files.getScheme() == "file":
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (shown, hidden)]
            jvm.java.nio.file.Files.createLink(*local)
            return
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(shown.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(hidden, shown, options)

    def _read(self, number: int) -> dict[str, Any]:
        files, path = folder_of(self.spark, self._name(number))
        source = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()
