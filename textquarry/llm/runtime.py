"""What the operators share: Arrow row mapping and tables that outlive executors."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: A word: a maximal run of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

#: Characters of text that Python code handles at once; bounds the memory of a worker.
SLICE_CHARS = 2_000_000


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names (other columns may clash with ours)."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_texts(docs: DataFrame, make: Callable[[], Callable[[list, list], dict]], schema: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Apply ``make()(ids, texts) -> columns`` to slices of bounded size of (doc_id, text).

    With several keys, ids are a list for each of them. ``make`` runs once in each task, so that loaded models are shared by the
    slices. Each row's text is handled whole; a slice holds about
    SLICE_CHARS characters or one longer text.
    """
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            ids, texts = [batch.column(i) for i in range(len(keys))], batch.column(len(keys))
            start, size = 0, 0
            lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
            for i, length in enumerate(lengths):
                size += length
                if size >= SLICE_CHARS or i + 1 == len(lengths):
                    of = [x.slice(start, i + 1 - start).to_pylist() for x in ids]
                    out = work(of if len(keys) > 1 else of[0], texts.slice(start, i + 1 - start).to_pylist())
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
                    start, size = i + 1, 0

    import pyarrow.compute  # noqa: F401  (pa.compute is used above)

    return docs.select(*keys, "text").mapInArrow(run, struct)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; where none is set and everything runs on this machine, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="textquarry-")
        atexit.register(shutil.rmtree, found, True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Where this process has written tables that are still there.
_WRITTEN: set[str] = set()


def durable(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: a short lineage that a lost executor doesn't touch.

    Results are lazy and may be read again, so what they read stays until
    ``clean`` is called or the folder's owner removes ``tables`` in it.
    Operators discard what no result reads.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.add(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._durable_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _WRITTEN.discard(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that durable has written, once nothing reads them any more."""
    for df in tables:
        _delete(df.sparkSession, df._durable_path)


def clean(spark: SparkSession) -> None:
    """Deletes all tables that durable has written in this process; to be called once results have been stored."""
    for path in list(_WRITTEN):
        _delete(spark, path)
