"""Lines of text files: paths, header checks, limits."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

#: In a header template, any text within a line.
ANY = "<<???>>"
#: Files of these kinds can't be read in pieces.
WHOLE = (".gz", ".zst", ".xz")


class NoFilesMatched(ValueError):
    """A pattern that matches no file."""


class UnexpectedHeader(ValueError):
    """A file that doesn't begin as its template says."""


def object_path(path: str) -> tuple[str, str] | None:
    """Bucket and object of a gs:// path, else None."""
    m = re.fullmatch(r"gs://([^/]+)/(.+)", path, re.DOTALL)
    return (m[1], m[2]) if m else None


def matching_files(spark: SparkSession, pattern: str, across_folders: bool | None = None) -> list[str]:
    """The files that a pattern matches, sorted, on any file system that Spark reads.

    across_folders: ``*`` also matches slashes, as object stores have no folders; the default for gs:// paths.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(conf)
    if across_folders if across_folders is not None else object_path(pattern) is not None:
        wanted = fs.makeQualified(path).toString()
        root = jvm.org.apache.hadoop.fs.Path(re.split(r"[*?\[]", wanted, maxsplit=1)[0].rpartition("/")[0] + "/")
        names, found = [], fs.listFiles(root, True) if fs.exists(root) else None
        while found is not None and found.hasNext():
            name = found.next().getPath().toString()
            if fnmatch.fnmatchcase(name, wanted):
                names.append(name)
        names.sort()
    else:
        names = sorted(f.getPath().toString() for f in fs.globStatus(path) or [] if f.isFile())
    if not names:
        raise NoFilesMatched(f"no file matches {pattern}")
    return names


def line_matches(template: str, line: str) -> bool:
    """Whether a line, without outer blanks, is the template's, whose ``<<???>>`` stand for any text."""
    return re.fullmatch(".*".join(map(re.escape, template.strip().split(ANY))), line.strip(), re.DOTALL) is not None


def check_header(lines: Iterable[str], template: list[str], name: str = "") -> None:
    """Raise ``UnexpectedHeader`` for the first line (from 0) that isn't the template's."""
    given = iter(lines)
    for k, want in enumerate(template):
        line = next(given, None)
        if line is None or not line_matches(want, line):
            raise UnexpectedHeader(f"{name}: line {k} is {line!r}, not {want!r}")


def read_lines(spark: SparkSession, pattern: str, header: list[str] | None = None, max_lines: int | None = None, partitions: int | None = None) -> DataFrame:
    """Lines as ``value``, split at newlines only; gz and bz2 are unpacked.

    The header of the first file, by name, is checked before a plan is made.
    partitions: deal lines out anew. Without a number, files that can't be read in
    pieces, and lines after a limit, are dealt to as many tasks as a shuffle has; 0: never.
    max_lines: of all files together; a number of lines that one task can pass on.
    """
    names = matching_files(spark, pattern)
    text = spark.read.option("lineSep", "\n")
    if header:
        check_header((r["value"] for r in text.text(names[0]).limit(len(header)).collect()), header, names[0])
    lines = text.text(names)
    if max_lines is not None:
        lines = lines.limit(max_lines)
    if partitions is None and (max_lines is not None or any(n.endswith(WHOLE) for n in names)):
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(partitions) if partitions else lines


def iterate(records: DataFrame) -> Iterator:
    """Records one by one on the driver, a partition at a time in its memory."""
    return records.toLocalIterator(prefetchPartitions=True)
