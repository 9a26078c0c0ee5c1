"""Token counts: rollups by source, language and tokenizer version, kept by deltas.

A batch holds signed changes of documents. Committing it adds the batch's own
small rollup and its ledger rows to the store, under the batch's name; a batch
that is committed already changes nothing, so a replay is harmless. Totals are
sums over all batches' rollups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, body, materialize, small_batches
from .packing import word_ids

KEYS = ["source", "lang", "tokenizer"]
ROLLUP = "source string, lang string, tokenizer string, documents long, tokens long"
LEDGER = "doc_id long, source string, lang string, tokenizer string, tokens long, sign int"


def count_tokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, source, lang, tokens, line_tokens); a null or empty text has no tokens.

    ``line_tokens`` counts the text without its repeated lines. Both come from one
    reading of the text, so a revision by lines moves counts and never texts.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        encoder = word_ids(tokenizer_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = part["text"].to_pylist()
                counts = np.array([len(x) // 4 for x in encoder.encode(texts)], np.int64)
                lines = [list(dict.fromkeys(t.split("\n"))) for t in texts]
                fewer = [i for i, t in enumerate(texts) if len(lines[i]) <= t.count("\n")]
                by_lines = counts.copy()
                by_lines[fewer] = [len(x) // 4 for x in encoder.encode(["\n".join(lines[i]) for i in fewer])]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["source"], part["lang"], pa.array(counts), pa.array(by_lines)], names=["doc_id", "source", "lang", "tokens", "line_tokens"])

    return docs.select("doc_id", "source", "lang", body().alias("text")).mapInArrow(run, "doc_id long, source string, lang string, tokens long, line_tokens long")


class Store:
    """Committed batches below a path in the shared folder.

    ``ledger/batch=NAME`` has the signed rows of a batch, ``rollup/batch=NAME``
    their sums. The rollup is written last, and its ``_SUCCESS`` file is the
    commit: a batch that broke off before it is written anew.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, kind: str, batch: str) -> str:
        return f"{self.path}/{kind}/batch={batch}"

    def _committed_path(self, batch: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._place('rollup', batch)}/_SUCCESS")

    def committed(self, batch: str) -> bool:
        done = self._committed_path(batch)
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def batches(self) -> list[str]:
        """Names of all committed batches; one that broke off before its rollup was whole is none."""
        done = self._committed_path("*")
        found = done.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(done)
        return sorted(x.getPath().getParent().getName().removeprefix("batch=") for x in found or [])

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add signed rows (LEDGER) under the batch's name; False if they are there already."""
        if self.committed(batch):
            return False
        changes.select("doc_id", *KEYS, "tokens", F.col("sign").cast("int").alias("sign")).write.mode("overwrite").parquet(self._place("ledger", batch))
        rows = self.spark.read.schema(LEDGER).parquet(self._place("ledger", batch))
        sums = rows.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
        sums.write.mode("overwrite").parquet(self._place("rollup", batch))
        return True

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [self._place(kind, b) for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def insert(self, batch: str, counted: DataFrame) -> bool:
        return self.commit(batch, counted.withColumn("sign", F.lit(1)))

    def live(self, keys: DataFrame) -> DataFrame:
        """What the committed batches hold of (doc_id, tokenizer) keys: the rows to take back. What was put in without doc_id no key names, so it stays."""
        held = self._read("ledger", LEDGER).join(keys.select("doc_id", "tokenizer").distinct(), ["doc_id", "tokenizer"], "left_semi")
        net = held.groupBy("doc_id", *KEYS, "tokens").agg(F.sum("sign").alias("n")).where("n > 0")
        return net.withColumn("sign", -F.col("n")).drop("n")

    def delete(self, batch: str, keys: DataFrame) -> bool:
        """Take back the rows of (doc_id, tokenizer) keys that committed batches hold."""
        return self.commit(batch, self.live(keys))

    def revise(self, batch: str, counted: DataFrame) -> bool:
        """Replace what committed batches hold for the counted documents by the new counts; those without doc_id replace nothing and are left out."""
        counted = counted.where("doc_id is not null").select("doc_id", *KEYS, "tokens", F.lit(1).cast("long").alias("sign"))
        return self.commit(batch, counted.unionByName(self.live(counted)))

    def totals(self) -> DataFrame:
        """Documents and tokens by key; keys that came to nothing are left out."""
        sums = self._read("rollup", ROLLUP).groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents <> 0 or tokens <> 0")


def maintained(docs: DataFrame, labels: DataFrame, tokenizer_path: str, store: Store) -> DataFrame:
    """Totals after a load, a deletion, a revision and a replay of the load.

    The load inserts all documents, counted by words and by the tokenizer. The
    deletion takes back documents labelled toxic. The revision counts documents
    labelled as of low quality, and not as toxic, anew, without repeated lines. Null
    keys are keys of their own; repeated rows count each.
    """
    counted = materialize(count_tokens(docs, tokenizer_path).withColumn("tokenizer", F.lit("word_bpe_49k")), "token-counts")
    space = docs.select("doc_id", "source", "lang", F.size(F.array_remove(F.split(body(), f"[{SPACE}]+"), "")).cast("long").alias("tokens"), F.lit("space").alias("tokenizer"))
    load = counted.drop("line_tokens").unionByName(space)
    store.insert("load", load)
    toxic = labels.where("toxic = 1").select("doc_id")
    store.delete("toxic", toxic.select("doc_id", F.explode(F.array(F.lit("word_bpe_49k"), F.lit("space"))).alias("tokenizer")))
    low = labels.where("quality = 0").join(toxic, "doc_id", "left_anti").select("doc_id").distinct()
    store.revise("lines", counted.join(low, "doc_id", "left_semi").withColumn("tokens", F.col("line_tokens")))
    store.insert("load", load)
    return store.totals()
