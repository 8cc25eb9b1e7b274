"""Session settings that plans over parsed text depend on."""

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_own_folder: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster names in ``spark.checkpoint.dir``; on one machine, where that is unset, in a temporary one."""
    global _own_folder
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if _own_folder is None:
            _own_folder = tempfile.mkdtemp(prefix="loomseq-")
            atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
        folder = f"file://{_own_folder}"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"



def for_parsed_text(spark: SparkSession) -> None:
    """Turns the inference of constraints off.

    The optimizer rewrites every filter in terms of every alias below it; over
    the wide, nested expressions that parse a record this takes minutes for a
    self-join (56 s against 2 s for running depths) and infers nothing of use.
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")


def fields_once(line: Column, separator: str = "\t") -> Column:
    """The fields of a line, as the one row of a generator.

    Predicates on fields are not pushed below a generator, where each mention of
    a field would split the line anew (idxstats at sf0.1: 40 s against 5 s).
    """
    return F.explode(F.array(F.split(line, separator)))
