"""Secret scan: candidate strings, judged by how many repositories and owners hold the same one.

Candidates are found in every whole text: assignments to a password-like name, cloud access keys, long hex strings, and,
as spans that the method adds, private key blocks, bearer tokens and credentials in addresses. Each candidate's value is
hashed; the corpus gives, for each hash, the number of distinct owners and repositories. A value that more than
``COPIED_OWNERS`` owners have, or that one owner has in more than ``COPIED_REPOSITORIES`` repositories, is a widely copied
example; one that few have looks live. Spans of every kind are
reported, each marked live or copied.

Counting goes over distinct (hash, owner, repository) rows, then (hash, owner), then hash, each with map-side
aggregation, so a value copied into a third of all texts never gathers in one task. The counts of a hash are joined
back to the candidates; Spark splits a hot hash there.

A null text counts as empty; a null owner or repository is one of its own. Repeated rows count once as repository. An empty
table gives an empty result. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.text import quoted, slices
from arealis.session import stored

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "private", "bearer", "address")
COPIED_OWNERS = 3
#: Repositories of one owner that may hold a value that looks live.
COPIED_REPOSITORIES = 10

# Patterns of the base kinds (letters of names in either case, ASCII only).
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Patterns of the added kinds.
PRIVATE = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}?-----END [A-Z ]*PRIVATE KEY-----")
BEARER = re.compile(r"\b[Bb]earer\x20+([A-Za-z0-9._~+/-]{20,}=*)")
ADDRESS = re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[^\s/:@]++:([^\s/@]{6,}+)@")


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of every candidate."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [("assign", *m.span(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", *m.span(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= ACCESS_CHARS]
    found += [("hex", *m.span(), m.group()) for m in HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [("private", *m.span(), m.group()) for m in PRIVATE.finditer(text)]
    if "earer " in text:
        found += [("bearer", *m.span(), m.group(1)) for m in BEARER.finditer(text)]
    if "://" in text:
        found += [("address", *m.span(), m.group(1)) for m in ADDRESS.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


SCHEMA = (
    "row long, doc_id {id}, owner string, repository string, base_sha256 string, "
    "found array<struct<kind:string, start:int, end:int, value:long>>"
)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Candidates of every row with the hash of their values, and the digest of the base spans."""
    columns = docs.select(
        F.monotonically_increasing_id().alias("row"), quoted(doc_id).alias("doc_id"), quoted(owner).cast("string").alias("owner"),
        quoted(repository).cast("string").alias("repository"), quoted(text).alias("text"),
    )
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            found, digests = [], []
            for t in texts:
                spans = candidates(t)
                base = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans if k in BASE_KINDS)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                found.append([
                    {"kind": k, "start": a, "end": b, "value": xxhash.xxh64_intdigest(v.encode("utf-8", "surrogatepass")) - (1 << 63)}
                    for k, a, b, v in spans
                ])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(digests, pa.string()), pa.array(found, pa.list_(span))],
                names=["row", "doc_id", "owner", "repository", "base_sha256", "found"],
            )

    return columns.mapInArrow(run, SCHEMA.format(id=dict(columns.dtypes)["doc_id"]))


def ownership(spans: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each value, and the most repositories that one owner has (value, owner, repository)."""
    once = spans.select("value", "owner", "repository").distinct()
    per_owner = once.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("repositories").alias("per_owner"))


def _joined(spans: Column) -> Column:
    """kind:start:end of an array of spans in its order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _marks(spans: Column) -> Column:
    """live or copied, of an array of spans in its order."""
    return F.array_join(F.transform(spans, lambda s: F.when(s["copied"], "copied").otherwise("live")), ",")


def secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id",
    copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """One row per row of ``docs``: counts of base spans, digest of base spans, all spans, their marks, live and copied counts, and
    the most owners and the most repositories that one of its values has."""
    rows = stored(scan(docs, doc_id, text, owner, repository), "secret-rows")
    spans = rows.select("row", "owner", "repository", F.posexplode("found").alias("at", "span")).select(
        "row", "owner", "repository", "at", "span.*"
    )
    widely = (F.col("owners") > copied_owners) | (F.col("per_owner") > copied_repositories)
    copied = spans.join(ownership(spans), "value").withColumn("copied", widely)
    count = lambda when: F.count_if(when)
    per_row = copied.groupBy("row").agg(
        *[count(F.col("kind") == k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sort_array(F.collect_list(F.struct("at", "kind", "start", "end", "copied"))).alias("kept"),
        count(~F.col("copied")).alias("n_live"), count(F.col("copied")).alias("n_copied"),
        F.max("owners").alias("most_owners"), F.max("repositories").alias("most_repositories"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.select("row", "doc_id", "base_sha256").join(per_row, "row", "left").select(
        "doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), "base_sha256",
        F.coalesce(_joined(F.col("kept")), F.lit("")).alias("spans"), F.coalesce(_marks(F.col("kept")), F.lit("")).alias("marks"),
        zero("n_live"), zero("n_copied"), zero("most_owners"), zero("most_repositories"),
    )
