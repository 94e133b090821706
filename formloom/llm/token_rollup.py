"""Token counts by source, language and tokenizer version, kept up to date from signed changes.

A store is a folder:
  ledger   signed entries by document, a part a batch, in BUCKETS buckets by doc_id: (doc_id, source, lang, version, docs, tokens, chars)
  totals   their sums by (source, lang, version), additive over batches
  _log     what was committed, in order: an entry names a batch and its part. Entry n is a file that only one writer can make

A batch counts from its log entry on; a part without one never happened. A batch that is committed twice counts once: the second time nothing
is done. A commit reads what its documents have, writes its part, and then claims the next entry; if another one has claimed it meanwhile, it starts
anew from what holds then. It reads the buckets of its own documents only. `compact` sums all parts into one, as one more entry; parts that it
replaces are no longer read.

Changes are rows (op, doc_id, source, lang, version, tokens, chars):
  insert   adds a document under a version; one that is there under that version is revised instead
  delete   takes back all that the document has under the version (under all versions where it is null)
  revise   replaces what the document has under the version
What a document has is read from the ledger, so changes need not carry old counts. Of several changes of one document and
version in a batch, the one with the greatest `seq` holds (ties: delete, then greater counts). A null op counts as insert; null tokens and
chars count as 0; null source, lang and version are groups of their own. A change without doc_id has no document to
look up: its insert is added as it is, its delete and revise are dropped.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "version"]
SUMS = ["docs", "tokens", "chars"]
ENTRY = "doc_id long, source string, lang string, version string, docs long, tokens long, chars long"


BUCKETS = 64


def bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")


class Rollup:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _log(self) -> list[dict]:
        """The entries in order. One without content, whose writer ended before it wrote, counts for nothing."""
        fs, at = self._fs(), self._path("_log")
        if not fs.exists(at):
            return []
        read, out = self.spark._jvm.org.apache.commons.io.IOUtils, []
        for path in sorted(str(s.getPath()) for s in fs.listStatus(at) if not s.getPath().getName().startswith(".")):
            for _ in range(100):
                stream = fs.open(self._hadoop.Path(path))
                text = read.toString(stream, "UTF-8")
                stream.close()
                if text.endswith("}"):
                    break
                time.sleep(0.05)
            out.append(json.loads(text) if text.endswith("}") else {})
        return out

    def _claim(self, number: int, entry: dict) -> bool:
        """Writes entry `number`; False if there is one."""
        try:
            stream = self._fs().create(self._path("_log", f"{number:08d}"), False)
        except Exception as e:
            if "exist" not in str(e).lower():
                raise
            return False
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        return True

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        return sorted(e["batch"] for e in self._log() if "batch" in e)

    def _parts(self, log: list[dict]) -> list[str]:
        """Parts that hold: the last compacted one and those after it."""
        last = max((i for i, e in enumerate(log) if "compacted" in e), default=0)
        return [e["part"] for e in log[last:] if "part" in e]

    def ledger(self, buckets: list[int] | None = None, log: list[dict] | None = None) -> DataFrame:
        """What each document has, by its keys; of all documents or those of some buckets."""
        parts = self._parts(self._log() if log is None else log)
        if not parts:
            return self.spark.createDataFrame([], ENTRY)
        kept = self.spark.read.schema(ENTRY + ", part string, bucket int").option("basePath", f"{self.root}/ledger").parquet(*(f"{self.root}/ledger/part={p}" for p in parts))
        kept = kept if buckets is None else kept.where(F.col("bucket").isin(buckets))
        held = kept.groupBy("doc_id", *KEYS).agg(*(F.sum(c).alias(c) for c in SUMS))
        return held.where("docs <> 0 or tokens <> 0 or chars <> 0")

    def totals(self) -> DataFrame:
        """Sums by source, language and version over all batches."""
        schema, parts = ENTRY.replace("doc_id long, ", ""), self._parts(self._log())
        held = self.spark.read.schema(schema).parquet(*(f"{self.root}/totals/{p}" for p in parts)) if parts else self.spark.createDataFrame([], schema)
        return held.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS)).where("docs <> 0 or tokens <> 0 or chars <> 0")

    def _write(self, entries: DataFrame) -> str:
        """A part of these entries, and its totals."""
        part = uuid.uuid4().hex
        entries.withColumn("bucket", bucket()).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/ledger/part={part}")
        written = self.spark.read.schema(ENTRY).parquet(f"{self.root}/ledger/part={part}")
        written.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS)).write.parquet(f"{self.root}/totals/{part}")
        return part

    def _drop(self, part: str) -> None:
        self._fs().delete(self._path("ledger", f"part={part}"), True)
        self._fs().delete(self._path("totals", part), True)

    def compact(self) -> None:
        """One part in place of all."""
        while True:
            log = self._log()
            part = self._write(self.ledger(log=log))
            if self._claim(len(log), {"compacted": len(log), "part": part}):
                return
            self._drop(part)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies the changes as one batch. False if the batch was committed before."""
        seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
        zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
        changes = changes.select(
            F.coalesce("op", F.lit("insert")).alias("op"), F.col("doc_id").cast("long").alias("doc_id"),
            *(F.col(c).cast("string").alias(c) for c in KEYS), F.lit(1).cast("long").alias("docs"),
            zero("tokens").alias("tokens"), zero("chars").alias("chars"), seq.cast("long").alias("seq"),
        )
        while True:
            log = self._log()
            if any(e.get("batch") == batch for e in log):
                return False
            touched = [r.b for r in changes.select(bucket().alias("b")).distinct().collect()] if log else []
            part = self._write(self._signed(changes, self.ledger(touched, log)))
            if self._claim(len(log), {"batch": batch, "part": part}):
                return True
            self._drop(part)

    def _signed(self, changes: DataFrame, ledger: DataFrame) -> DataFrame:
        """Entries that turn what documents have into what the changes say."""
        loose = changes.where("doc_id is null and op = 'insert'").select("doc_id", *KEYS, *SUMS)
        known = changes.where("doc_id is not null")
        last = F.max(F.struct("seq", (F.col("op") == "delete").alias("gone"), "tokens", "chars", "source", "lang", "docs", "op")).alias("l")
        known = known.groupBy("doc_id", "version").agg(last).select("doc_id", "version", "l.*")
        held = ledger.where("doc_id is not null").alias("h")
        hit = known.select("doc_id", "version", F.col("op").alias("_op")).alias("c")
        same = (F.col("h.doc_id") == F.col("c.doc_id")) & F.col("h.version").eqNullSafe(F.col("c.version"))
        taken = held.join(hit, same, "left_semi")
        every = known.where("op = 'delete' and version is null").select("doc_id")
        taken = taken.unionByName(held.join(hit, same, "left_anti").join(every, "doc_id", "left_semi"))
        back = taken.select("doc_id", *KEYS, *((-F.col(c)).alias(c) for c in SUMS))
        there = ledger.select("doc_id", "version").distinct().alias("h")
        revised = known.where("op = 'revise'").alias("c").join(there, same, "left_semi")  # nothing there: nothing to revise
        new = known.where("op = 'insert'").unionByName(revised).select("doc_id", *KEYS, *SUMS)
        return back.unionByName(new).unionByName(loose)


def word_tokens(text):
    """Version `words`: runs of other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quad_tokens(text):
    """Version `quads`: groups of four characters, the last one may be shorter."""
    return F.ceil(F.coalesce(F.char_length(text), F.lit(0)) / 4).cast("long")


VERSIONS = {"words": word_tokens, "quads": quad_tokens}


def counted(df: DataFrame, version: str, op: str, text_col: str = "text") -> DataFrame:
    """Changes that say what each row of `df` (doc_id, source, lang, text) has under a version."""
    text = F.col(text_col).cast("string")
    chars = F.coalesce(F.char_length(text), F.lit(0)).cast("long")
    return df.select(F.lit(op).alias("op"), "doc_id", "source", "lang", F.lit(version).alias("version"), VERSIONS[version](text).alias("tokens"), chars.alias("chars"))
