"""Versions of a stored model, so that replacing one never leaves a gap.

Each write goes to a folder of its own below the model's path. A version
counts once Spark's commit has put its ``_SUCCESS`` file there: that single
step switches readers to it. A write that fails, or a driver that dies on the
way, leaves the version before in force, and scans of it go on.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

DONE = "_SUCCESS"
_NAME = re.compile(r"version-(\d{12})-[0-9a-f]{32}")


class _Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.root = path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        """Folders of all versions, whole or not, oldest first."""
        root = self._path(self.root)
        if not self._files.exists(root):
            return []
        found = (entry.getPath().getName() for entry in self._files.listStatus(root))
        return sorted(name for name in found if _NAME.fullmatch(name))

    def _marker(self, name: str):
        return self._path(f"{self.root}/{name}/{DONE}")

    def whole(self) -> list[str]:
        return [name for name in self.names() if self._files.exists(self._marker(name))]

    def finish(self, name: str) -> None:
        """Mark a version as whole where Spark's commit is set not to."""
        if not self._files.exists(self._marker(name)):
            self._files.create(self._marker(name)).close()

    def remove(self, name: str) -> None:
        # without its marker first, so that a version never counts while it goes
        self._files.delete(self._marker(name), False)
        self._files.delete(self._path(f"{self.root}/{name}"), True)


def current(spark: SparkSession, path: str) -> str:
    """The folder of the last whole version; ``path`` itself where there is
    none, as in a folder of plain files."""
    whole = _Folder(spark, path).whole()
    return f"{path.rstrip('/')}/{whole[-1]}" if whole else path


def add(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Let ``write`` fill the folder of a new version and return that folder.

    The last ``keep`` whole versions stay for those who still read them; older
    ones, and rests of failed writes among these, are deleted. Of two
    writers at once, one wins, and the loser's rows stay whole as an earlier version.
    """
    if keep < 1:
        raise ValueError(f"at least one version must stay, not {keep}")
    folder = _Folder(spark, path)
    before = folder.whole()
    number = int(_NAME.fullmatch(before[-1]).group(1)) + 1 if before else 1
    name = f"version-{number:012d}-{uuid.uuid4().hex}"
    try:
        write(f"{folder.root}/{name}")
        folder.finish(name)
    except BaseException:
        folder.remove(name)
        raise
    oldest = folder.whole()[-keep:][0]
    for other in folder.names():
        if other < oldest:
            folder.remove(other)
    return f"{folder.root}/{name}"
