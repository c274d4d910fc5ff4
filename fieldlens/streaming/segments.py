"""Upkeep of a folder that grows by a batch at a time: batches become segments, segments become larger ones.

Layout below one folder: ``batches/batch_id=N`` as the stream writes them, ``segments/LO-HI`` with the merged rows of the
batches LO to HI, and ``manifest/version=V``, one text file with the segments that count. A reader takes the newest manifest whose
write was completed, its segments, and the batches behind the last of them. So a merge has three steps, and a crash
between any two of them loses and doubles nothing: a new segment that no manifest names is not read, the manifest is swapped by
the appearance of one marker file, and what it has replaced may be deleted at any later time.

``FANOUT`` neighbouring segments of one size class are merged into one of the next, so n batches leave about
FANOUT * log(n) folders and a row is rewritten about log(n) times.
"""

import math

from fieldlens.session import remove

FANOUT = 8
DONE = "_SUCCESS"


def _files(spark, path):
    """(Hadoop file system, path) on the driver: names are listed and deleted, contents are read and written by Spark."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def finished(spark, path, prefix=""):
    """Names of the folders below ``path`` that begin with ``prefix`` and were written to the end."""
    files, where = _files(spark, path)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith(prefix)]
    return [n for n in names if files.exists(_files(spark, f"{path}/{n}/{DONE}")[1])]


def drop(spark, path):
    remove(spark, path)


def newest_manifest(spark, out):
    """(version, [(first, last) batch of each segment]); (0, []) before the first merge."""
    versions = [int(n.split("=")[1]) for n in finished(spark, f"{out}/manifest", "version=")]
    if not versions:
        return 0, []
    lines = [r["value"] for r in spark.read.text(f"{out}/manifest/version={max(versions)}").collect()]
    return max(versions), sorted(tuple(map(int, line.split("-"))) for line in lines)


def batch_folder(out, number):
    return f"{out}/batches/batch_id={number}"


def segment_folder(out, segment):
    return f"{out}/segments/{segment[0]}-{segment[1]}"


def live_folders(spark, out):
    """Folders whose rows count, each batch once: the manifest's segments and the finished batches behind them."""
    _, segments = newest_manifest(spark, out)
    covered = segments[-1][1] if segments else -1
    batches = sorted(int(n.split("=")[1]) for n in finished(spark, f"{out}/batches", "batch_id="))
    return [segment_folder(out, s) for s in segments] + [batch_folder(out, b) for b in batches if b > covered]


def _size_class(segment, fanout):
    return int(math.log(segment[1] - segment[0] + 1, fanout) + 1e-9)


def merge_segments(spark, out, combine, below, fanout=FANOUT):
    """Merge the first batches behind the segments, and the last segments, as long as there are ``fanout`` of one size class.

    ``combine``: function from rows to the same rows with what belongs together added up. Run by the one writer of the folder, between its
    batches: batches before ``below`` are finished and will not be written again with other rows.
    """
    while True:
        version, segments = newest_manifest(spark, out)
        covered = segments[-1][1] if segments else -1
        batches = sorted(int(n.split("=")[1]) for n in finished(spark, f"{out}/batches", "batch_id="))
        waiting = [b for b in batches if covered < b < below]
        tail = segments[-fanout:]
        if len(waiting) >= fanout:
            tail = [(b, b) for b in waiting[:fanout]]
        elif len(tail) < fanout or len({_size_class(s, fanout) for s in tail}) > 1:
            return
        paths = [segment_folder(out, s) if s in segments else batch_folder(out, s[0]) for s in tail]
        new = tail[0][0], tail[-1][1]
        combine(spark.read.parquet(*paths)).write.mode("overwrite").parquet(segment_folder(out, new))
        kept = [s for s in segments if s not in tail] + [new]
        publish(spark, out, version + 1, kept)
        sweep(spark, out)


def publish(spark, out, version, segments):
    """Write a manifest; readers follow it from the moment its marker is there."""
    lines = spark.createDataFrame([(f"{a}-{b}",) for a, b in segments], "value string")
    lines.coalesce(1).write.mode("overwrite").text(f"{out}/manifest/version={version}")


def sweep(spark, out):
    """Delete what the newest manifest has replaced: covered batches, segments that it doesn't name, older manifests but the last one."""
    version, segments = newest_manifest(spark, out)
    if not version:
        return
    covered = segments[-1][1]
    for name in finished(spark, f"{out}/batches", "batch_id="):
        if int(name.split("=")[1]) <= covered:
            drop(spark, f"{out}/batches/{name}")
    named = {f"{a}-{b}" for a, b in segments}
    for name in finished(spark, f"{out}/segments"):
        if name not in named:
            drop(spark, f"{out}/segments/{name}")
    for name in finished(spark, f"{out}/manifest", "version="):
        if int(name.split("=")[1]) < version - 1:
            drop(spark, f"{out}/manifest/{name}")
