"""Token counts as rollups that are maintained by signed deltas.

A ledger holds, in the shared folder, four kinds of tables:

``entries/<batch>``  document entries of a batch: (doc_id, copy, tokenizer, source,
                     lang, n_tokens, alive), the newest of which is a document's
                     state, and the signed rows that the change comes to
``deltas/<batch>``   its signed sums: (source, lang, tokenizer, n_docs, n_tokens)
``commits/<batch>``  one row, written last: the batch is part of the ledger
``states/<number>``  all states after that many batches, and a row in
                     ``compactions`` once it is complete

A batch inserts, deletes and revises. Each change is compared with the
document's state: an insert adds its count, a delete takes the old count back,
a revision does both, so totals change by sums of signed rows and documents
are never counted again. Totals are the sum of the committed deltas, which are
as many rows as there are groups.

Entries lie in buckets by a hash of their document. A batch reads the buckets
that its changes fall into, from the last compaction on, so what it costs goes
with its size and not with the history; every ``COMPACT_EVERY`` batches the
states are written anew.

Commits are idempotent. A batch that is committed is skipped when it is
delivered again; one that failed before its commit row left nothing that is
read, and is overwritten. Within a batch the last change (``seq``) of a
document counts; changes repeated in full count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete, n_words, null_safe, scratch_path, written

CHANGES = "doc_id long, copy long, tokenizer string, op string, source string, lang string, n_tokens long, seq long"
ENTRIES = "doc_id long, copy long, tokenizer string, source string, lang string, n_tokens long, alive boolean"
SIGNED = ", signed array<struct<source:string,lang:string,n_docs:bigint,n_tokens:bigint>>"
DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
COMMIT = "batch string, number long"
BUCKET = ", bucket int"

INSERT, DELETE, REVISE = "insert", "delete", "revise"
#: Buckets of entries; batches between two compactions.
BUCKETS, COMPACT_EVERY = 64, 8
KEYS = ["doc_id", "copy", "tokenizer"]


def bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(BUCKETS)).cast("int").alias("bucket")


class Ledger:
    """Rollups by source, language and tokenizer version in ``folder``. One
    writer at a time commits."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _path(self, kind: str, batch: str) -> str:
        return f"{self.folder}/{kind}/batch={batch}"

    def _read(self, kind: str, schema: str, batches: list[str]) -> DataFrame:
        reader = self.spark.read.schema(schema)
        paths = [self._path(kind, b) for b in batches]
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def batches(self) -> list[str]:
        """Committed batches, oldest first."""
        if not self._exists(f"{self.folder}/commits"):
            return []
        rows = self.spark.read.schema(COMMIT).parquet(f"{self.folder}/commits").collect()
        return [r.batch for r in sorted(rows, key=lambda r: r.number)]

    def _compacted(self) -> int:
        """Batches that the newest complete table of states covers; 0 if there is none."""
        if not self._exists(f"{self.folder}/compactions"):
            return 0
        return self.spark.read.schema(COMMIT).parquet(f"{self.folder}/compactions").agg(F.max("number")).first()[0] or 0

    def state(self, buckets: list[int] | None = None) -> DataFrame:
        """The newest entry of every document and tokenizer, of some buckets if given."""
        done, upto = self.batches(), self._compacted()
        names = ["source", "lang", "n_tokens", "alive"]
        tables = [self._read("entries", ENTRIES + BUCKET, [b]).select(*KEYS, *names, "bucket", F.lit(upto + i).alias("_n"))
                  for i, b in enumerate(done[upto:], 1)]
        if upto:
            states = self.spark.read.schema(ENTRIES + BUCKET).parquet(f"{self.folder}/states/{upto}")
            tables.append(states.select(*KEYS, *names, "bucket", F.lit(upto).alias("_n")))
        if not tables:
            return self.spark.createDataFrame([], ENTRIES)
        entries = tables[0]
        for t in tables[1:]:
            entries = entries.unionByName(t)
        if buckets is not None:  # folders of the table: others are not read
            entries = entries.where(F.col("bucket").isin(buckets))
        return (entries.groupBy(*KEYS).agg(F.max_by(F.struct(*names), "_n").alias("_e"))
                .select(*KEYS, *[F.col(f"_e.{c}").alias(c) for c in names]))

    def compact(self) -> None:
        """Write all states as one table, so that later batches read no entries from before."""
        upto = len(self.batches())
        if upto in (0, self._compacted()):
            return
        path = f"{self.folder}/states/{upto}"
        if self._exists(path):
            delete(self.spark, path)
        self._put(self.state().withColumn("bucket", bucket()), path)
        self.spark.createDataFrame([("", upto)], COMMIT).coalesce(1).write.mode("append").parquet(f"{self.folder}/compactions")

    def _put(self, rows: DataFrame, path: str) -> None:
        rows.repartition("bucket").write.partitionBy("bucket").parquet(path)

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch of ``CHANGES``; False if it was committed before.

        An insert of a document that is there is a revision; a revision of one
        that is not is an insert; deleting what is not there changes nothing.
        A document is its doc_id, of which null is one, and its copy, which tells
        rows apart that share a doc_id: rows repeated with both are one change,
        the last by ``seq``, ties by the greatest. Null sources, languages and
        counts are a group, a group and zero.
        """
        done = self.batches()
        if batch in done:
            return False
        for kind in ("entries", "deltas", "commits"):
            if self._exists(self._path(kind, batch)):
                delete(self.spark, self._path(kind, batch))
        names = ["op", "source", "lang", "n_tokens"]
        last = (changes.groupBy("doc_id", F.coalesce("copy", F.lit(0).cast("long")).alias("copy"), "tokenizer")
                .agg(F.max(F.struct(F.coalesce("seq", F.lit(0)).alias("seq"), *names)).alias("_c"))
                .select(*KEYS, *[F.col(f"_c.{c}").alias(c) for c in names]))
        last, old = written(last, "changes"), None
        if done:
            touched = [r.bucket for r in last.select(bucket()).distinct().collect()]  # at most BUCKETS
            old = self.state(touched)
        else:
            old = self.state()
        old = old.select(*KEYS, F.struct("source", "lang", "n_tokens", "alive").alias("_old"))
        joined = null_safe(last, old, KEYS, "left")
        alive = F.coalesce(F.col("_old.alive"), F.lit(False))
        n_tokens = F.coalesce("n_tokens", F.lit(0).cast("long"))
        signed = joined.select(
            *KEYS, "source", "lang", n_tokens.alias("n_tokens"), (F.col("op") != DELETE).alias("alive"),
            F.filter(F.array(
                F.when(alive, F.struct(F.col("_old.source").alias("source"), F.col("_old.lang").alias("lang"),
                                       F.lit(-1).cast("long").alias("n_docs"), (-F.col("_old.n_tokens")).alias("n_tokens"))),
                F.when(F.col("op") != DELETE, F.struct("source", "lang", F.lit(1).cast("long").alias("n_docs"),
                                                       n_tokens.alias("n_tokens")))),
                lambda x: x.isNotNull()).alias("signed"), bucket())
        self._put(signed, self._path("entries", batch))
        (self._read("entries", ENTRIES + SIGNED + BUCKET, [batch]).select("tokenizer", F.explode("signed").alias("_s"))
         .select("tokenizer", "_s.*").groupBy("source", "lang", "tokenizer")
         .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
         .write.parquet(self._path("deltas", batch)))
        self.spark.createDataFrame([(batch, len(done))], COMMIT).coalesce(1).write.parquet(self._path("commits", batch))
        if len(done) + 1 - self._compacted() >= COMPACT_EVERY:
            self.compact()
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over the committed deltas;
        groups without documents are left out."""
        return (self._read("deltas", DELTAS, self.batches()).groupBy("source", "lang", "tokenizer")
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0"))


#: White space in a row that is not given to the library's pattern at once, which recurses on it.
LONG_RUN = 500
_RUNS = re.compile("([\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,})" % LONG_RUN)


def n_ids(coder, text: str) -> int:
    """Ids of a text, as ``encode_ordinary`` counts them where it can.

    The pattern takes white space in a row but for its last character as one
    word, and all of it at a text's end; a long run is handed over as that word,
    and its last character goes to what follows.
    """
    parts = _RUNS.split(text)
    if len(parts) == 1:
        return len(coder.encode_ordinary(text))
    total, first = 0, ""
    for k, part in enumerate(parts):
        if k % 2 == 0:
            total += len(coder.encode_ordinary(first + part)) if first + part else 0
        else:
            last = k + 2 == len(parts) and not parts[k + 1]
            word, first = (part, "") if last else (part[:-1], part[-1])
            total += len(coder._core_bpe.encode_single_piece(word.encode("utf-8")))
    return total


def counted(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, source, lang, n_words, guess, n_ids) of every row, in one read of
    the texts: its words, a quarter of its bytes, and its byte-level BPE ids.

    ``ranks_path`` names a file of base64 pieces and ranks, read on the driver
    and shipped (under a megabyte). A null or empty text has nothing to count.
    """
    with open(ranks_path, "rb") as f:
        ranks = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        coder = tiktoken.Encoding("counts", pat_str=pattern, special_tokens={}, mergeable_ranks={
            base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())})
        for batch in batches:
            counts = [n_ids(coder, t.as_py() or "") for t in batch.column(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(counts, pa.int64())],
                                             ["doc_id", "source", "lang", "n_words", "guess", "n_ids"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", n_words(F.col("text")).alias("n_words"),
        F.floor(F.coalesce(F.octet_length("text"), F.lit(0)) / 4).cast("long").alias("guess"), "text").mapInArrow(
        run, "doc_id long, source string, lang string, n_words long, guess long, n_ids long")


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows``, a written table, with ``copy``: 0 where the doc_id is of one row
    alone, else a number that no other row has."""
    again = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1 AND doc_id IS NOT NULL")
    numbered = rows.withColumn("_number", F.monotonically_increasing_id() + 1)
    return numbered.join(again, "doc_id", "left").withColumn("copy", F.when(
        F.col("doc_id").isNull() | F.col("_rows").isNotNull(), F.col("_number")).otherwise(F.lit(0))).drop("_number", "_rows")


def changes(rows: DataFrame, tokenizer: str, op: str, seq: int = 0, n_tokens: str = "n_tokens") -> DataFrame:
    """``CHANGES`` with one op from (doc_id, copy, source, lang, count)."""
    return rows.select("doc_id", "copy", F.lit(tokenizer).alias("tokenizer"), F.lit(op).alias("op"), "source", "lang",
                       F.col(n_tokens).cast("long").alias("n_tokens"), F.lit(seq).cast("long").alias("seq"))


#: Tokenizer versions of the query.
WORDS, BPE = "words-1", "byte_bpe_50k-1"
#: Documents with fewer words are taken out by the query's removal, and put back by its last batch.
SHORT = 10


def loaded(docs: DataFrame, ranks_path: str, pattern: str) -> Ledger:
    """The ledger of a corpus after five batches.

    The load inserts every row with its words and, for the BPE, a quarter of its
    bytes; the recount revises the latter to the real ids; the recount is
    delivered a second time and skipped; the removal deletes documents of fewer
    than ``SHORT`` words; the return inserts what the removal deleted.
    """
    spark = docs.sparkSession
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    rows = written(with_copies(written(counted(docs, ranks_path, pattern), "counted")), "numbered")
    recount = changes(rows, BPE, REVISE, n_tokens="n_ids")
    ledger.apply("load", changes(rows, WORDS, INSERT, n_tokens="n_words").unionByName(
        changes(rows, BPE, INSERT, n_tokens="guess")))
    ledger.apply("recount", recount)
    ledger.apply("recount", recount)
    short = rows.where(F.col("n_words") < SHORT)
    ledger.apply("removal", changes(short, WORDS, DELETE, n_tokens="n_words").unionByName(
        changes(short, BPE, DELETE, n_tokens="n_ids")))
    ledger.apply("return", changes(short, WORDS, INSERT, n_tokens="n_words").unionByName(
        changes(short, BPE, INSERT, n_tokens="n_ids")))
    return ledger


def whole_totals(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(source, lang, tokenizer, n_docs, n_tokens) of a whole corpus, by deltas.

    Every row counts: those with a null or a repeated doc_id are documents of
    their own. Null sources and languages are groups; null, empty and blank texts
    are documents without tokens; an empty table has no totals; other columns are
    not read.
    """
    return loaded(docs, ranks_path, pattern).totals()
