"""Mark and sweep: folders that no commit needs any more are deleted.

A folder is live if the commit logs say so:

- of a dimension: the closed folders of its history and the last ``RECENT`` loads;
- the blacklist's last folder; of the report and the rejects those that are the
  last for some day or file; of the id index its live folders;
- of the card states the newest of each of the last ``SNAPSHOTS`` days; of the card profile
  the folders that its last refresh names.

Everything else is left over: replaced, merged, or written by a load that died or
is still running. The first sweep that finds such a folder marks it; a later one
deletes it once its mark is ``older_than``. So a running load or report has
that long to end, and a folder that became live loses its mark. Times are those
of the file system, not of a driver's clock. The fact is never swept.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from fraudlake.plans import commitlog, idindex, profile, warehouse as W
from fraudlake.schemas import DIMS

SNAPSHOTS = 8


def live(spark: SparkSession, wh: W.Warehouse) -> dict[str, set[str]]:
    """Per swept folder the names in it that must stay."""
    out = {}
    for spec in DIMS.values():
        loads, closed, _ = W.live_folders(W.history_log(spark, wh, spec.name))
        out[wh.dim(spec)] = {f"run={f}" for f in [*closed, *(loads[r] for r in sorted(loads)[-W.RECENT:])]}
    newest = Window.orderBy(F.desc("last_day"))     # a row a day of the log
    states = W.current_folders(spark, wh, "CARD_STATE", ["last_day"]) \
              .withColumn("n", F.row_number().over(newest)).filter(F.col("n") <= SNAPSHOTS)
    tables = {wh.blacklist: W.current_folders(spark, wh, "BLACKLIST", []), wh.report: W.report_folders(spark, wh),
              wh.rejects: W.current_folders(spark, wh, "REJECTS", ["file_name"]), wh.card_state: states}
    for path, folders in tables.items():
        out[path] = {f"run={r['folder']}" for r in folders.select("folder").distinct().collect()}
    out[wh.ids] = set(idindex.live(spark, wh))
    out[wh.profile] = {f"run={f}" for f in profile.state(spark, wh)[1]}
    return out


def sweep(spark: SparkSession, wh: W.Warehouse, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Mark what is not live and delete what was marked ``older_than`` ago;
    returns the deleted folders. Running it at any time, also twice at once or
    after it died, is safe. ``older_than`` must exceed the longest load or report."""
    marks = wh.path("marks")
    # Listed before the logs are read: what is committed in between is in the logs.
    found = {path: commitlog.listing(spark, path) for path in
             [*(wh.dim(s) for s in DIMS.values()), wh.blacklist, wh.report, wh.rejects, wh.card_state, wh.ids, wh.profile]}
    keep = live(spark, wh)
    probe = f"now-{uuid.uuid4().hex}"
    commitlog.put_once(spark, f"{marks}/{probe}", "")
    now = commitlog.listing(spark, marks)[probe]
    commitlog.delete(spark, f"{marks}/{probe}")
    deleted = []
    for path, names in found.items():
        own = f"{marks}/{path.rsplit('/', 1)[1]}"
        marked = commitlog.listing(spark, own)
        for name in names:
            if name.startswith(("_", ".")):
                continue
            if name in keep[path]:
                if name in marked:
                    commitlog.delete(spark, f"{own}/{name}")
            elif name not in marked:
                commitlog.put_once(spark, f"{own}/{name}", "")
            elif now - marked[name] >= older_than.total_seconds() * 1000:
                commitlog.delete(spark, f"{path}/{name}")
                commitlog.delete(spark, f"{own}/{name}")
                deleted.append(f"{path}/{name}")
    return deleted
