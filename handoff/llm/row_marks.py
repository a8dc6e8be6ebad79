"""Keep chosen rows of a table without shuffling it.

``placed`` writes the rows once, each with its place (task number and count within the task). An operator
decides on places, which are 8 bytes each; ``keep_places`` writes the chosen ones by task number, and a
scan of the placed rows drops the others, looking up one task's places at a time. It is one plan at
every size: no text is shuffled, and a task holds the places of one task of the first pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handoff.llm.common import open_folder, quoted, shared_path, write_shared

#: ``monotonically_increasing_id`` holds the task's number above this bit.
TASK_BIT = 33
#: Tasks whose places lie in one folder (one file).
TASKS_A_FOLDER = 8


def placed(rows: DataFrame, place: str) -> DataFrame:
    """The rows written to the shared folder with their place in column ``place`` (a free name)."""
    return write_shared(rows.withColumn(place, F.monotonically_increasing_id()), "rows")


def keep_places(rows: DataFrame, place: str, chosen: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The ``columns`` of those ``placed`` rows whose place is in ``chosen`` (one long column, no repeats)."""
    name = chosen.columns[0]
    lists = chosen.groupBy(F.shiftright(name, TASK_BIT).alias("task")).agg(F.sort_array(F.collect_list(name)).alias("places"))
    path = shared_path(rows.sparkSession, "places")
    folder = F.floor(F.col("task") / TASKS_A_FOLDER).cast("long")
    lists.withColumn("folder", folder).repartition("folder").write.partitionBy("folder").parquet(path)

    def places_of(task: int) -> np.ndarray:
        fs, root = open_folder(f"{path}/folder={task // TASKS_A_FOLDER}")
        if fs.get_file_info(root).type == pafs.FileType.NotFound:
            return np.empty(0, np.int64)
        files = pads.dataset(root, filesystem=fs, format="parquet", exclude_invalid_files=True)
        found = files.to_table(columns=["places"], filter=pads.field("task") == task).column("places").combine_chunks()
        return found.flatten().to_numpy() if len(found) else np.empty(0, np.int64)

    held: dict[int, np.ndarray] = {}

    def keep(at: pa.Array) -> pa.Array:
        at = at.to_numpy()
        tasks = at >> TASK_BIT
        mask = np.zeros(len(at), bool)
        for task in np.unique(tasks).tolist():
            if task not in held:
                held.clear()
                held[task] = places_of(task)
            own = np.flatnonzero(tasks == task)
            if len(held[task]):
                near = held[task][np.minimum(np.searchsorted(held[task], at[own]), len(held[task]) - 1)]
                mask[own] = near == at[own]
        return pa.array(mask)

    # only the places go to Python; the rows stay where they are
    return rows.where(F.arrow_udf(keep, "boolean")(F.col(place))).select(*[F.col(quoted(c)) for c in columns])
