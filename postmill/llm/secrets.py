"""Secret scans over a ledger of blobs.

A text is a blob, named by the SHA-256 of its bytes. The ledger is a table that says which
(blob, rule version) pairs were scanned, with what was found. A scan looks at the distinct blobs of its
input, takes only those pairs the ledger does not have, adds them, and joins the findings of all
blobs back to every path that holds them. Scanning a table again, or a later version of it, reads old blobs
only to name them; new rules scan all blobs once more under their own version.

Rules: ``assign``, ``access`` and ``hex`` as the base kinds, and two that the method adds: ``pem`` (a private
key block) and ``jwt`` (three base64url parts that begin as a JSON header does). Spans are code points, end exclusive.

Defined results: a null text is the empty blob; repeated rows each come back; the ledger may be
empty or missing, or hold a pair twice; an empty table gives no rows. Columns of any name come back, but for those that are added here.
A text that comes once and is new is scanned where it is read. The others are shuffled; copies of a blob meet in their own
task before, so however many there are, each task sends one; their paths are spread.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.common import fresh, may_be_among, quoted, slices, spread_join, staged
from postmill.session import scratch_path

RULE_VERSION = 1
# Fixed patterns. Kinds in the order in which spans that begin together are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# A key reaches from a header to the first END after it, which must be its footer. Headers may share their dashes.
PEM_HEADER = re.compile(r"(?=(-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----))")
PEM_FOOTER = re.compile(r"-----END [A-Z ]{0,40}PRIVATE KEY-----")
# Three runs of these with a dot between each two, of 8 characters at least; the first counts from behind "eyJ".
JWT_RUN = re.compile(r"[A-Za-z0-9_-]+")
JWT_LEAST = 8
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "jwt")
# What a text must hold for the rules to be tried on it; a wider net than they are.
SUSPECT = r"(?i:password|passwd|secret|token|api_?key)|AKIA[A-Z0-9]|[0-9a-f]{24}|PRIVATE KEY|eyJ[A-Za-z0-9_-]{8}"
FOUND = "array<struct<kind: string, start: long, end: long>>"


def find_keys(text: str) -> Iterator[tuple[int, int]]:
    """Private keys, in one pass: where a header's END is, is looked up once for all headers before it."""
    at, end = 0, -1
    for header in PEM_HEADER.finditer(text):
        if header.start() < at:
            continue
        if end < header.end(1):
            end = text.find("-----END", header.end(1))
            if end < 0:
                return
        footer = PEM_FOOTER.match(text, end)
        if footer:
            at = footer.end()
            yield header.start(), at


def find_tokens(text: str) -> Iterator[tuple[int, int]]:
    """JSON web tokens, in one pass over the runs they are made of."""
    if "eyJ" not in text:
        return
    first = second = None
    for run in JWT_RUN.finditer(text):
        third = run.span()
        joined = first and first[1] + 1 == second[0] and second[1] + 1 == third[0] and text[first[1]] == text[second[1]] == "."
        if joined and min(second[1] - second[0], third[1] - third[0]) >= JWT_LEAST:
            # A negative end would count from the end of the text.
            start = text.find("eyJ", first[0], max(0, first[1] - JWT_LEAST))
            if start >= 0:
                yield start, third[1]
                first = second = None
                continue
        first, second = second, third


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed, then end."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 or more is the same as a whole run that is long enough.
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    found += [("pem", *span) for span in find_keys(text)]
    found += [("jwt", *span) for span in find_tokens(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def blob_id(text: str = "text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for part in slices(batch, "text"):
            suspect = pc.match_substring_regex(part["text"], SUSPECT)
            spans, digests = [], []
            for text, look in zip(part["text"], suspect, strict=True):
                found = find_secrets(text.as_py()) if look.as_py() else []
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                base = listed([s for s in found if s[0] in BASE])
                digests.append((hashlib.sha256(base.encode()).hexdigest(), listed(found)))
            yield pa.RecordBatch.from_arrays(
                [part["blob"], pa.array(spans, kind), pa.array([d[0] for d in digests]), pa.array([d[1] for d in digests])],
                ["blob", "found", "base_sha256", "spans"],
            )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; an empty frame where there is none yet."""
    schema = f"blob string, found {FOUND}, base_sha256 string, spans string, rule_version int"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def findings(spark: SparkSession, path: str, rule_version: int = RULE_VERSION) -> DataFrame:
    """The ledger's blobs under one rule version, each once: scans at the same time may both have added one."""
    rows = read_ledger(spark, path).filter(F.col("rule_version") == rule_version)
    return rows.drop("rule_version").dropDuplicates(["blob"])


def scan_new(docs: DataFrame, ledger_path: str, text_column: str = "text", rule_version: int = RULE_VERSION) -> None:
    """Scan the blobs of ``docs`` that the ledger lacks under this rule version, and add them.

    A file is committed as a whole, so a scan that breaks off adds nothing, and one that is
    run again finds what the first has added.
    """
    blobs = docs.select(blob_id(text_column).alias("blob"), F.coalesce(text_column, F.lit("")).alias("text"))
    known = read_ledger(docs.sparkSession, ledger_path).filter(F.col("rule_version") == rule_version).select("blob")
    # Most blobs are new and come once: a bitmap tells them, and their texts are not moved.
    key = F.xxhash64("blob")
    copied = blobs.groupBy(key.alias("key")).agg(F.count("*").alias("rows")).filter("rows > 1").select("key")
    in_doubt = may_be_among(staged(copied.union(known.select(key)), "in_doubt"), "key")(key)
    unseen = blobs.filter(in_doubt).dropDuplicates(["blob"]).join(known, "blob", "left_anti")
    unseen = blobs.filter(~in_doubt).unionByName(unseen)
    found = unseen.select("blob", "text").mapInArrow(_scan, f"blob string, found {FOUND}, base_sha256 string, spans string")
    found.withColumn("rule_version", F.lit(rule_version)).write.mode("append").parquet(ledger_path)


def scan(
    docs: DataFrame, ledger_path: str | None = None, text_column: str = "text", rule_version: int = RULE_VERSION
) -> DataFrame:
    """All rows of ``docs`` without their text, with ``blob``, ``found``, ``base_sha256`` and ``spans``.

    Without a path the ledger is a fresh one in the scratch folder.
    """
    ledger_path = ledger_path or scratch_path(docs.sparkSession, "ledger")
    scan_new(docs, ledger_path, text_column, rule_version)
    kept = [c for c in docs.columns if c not in (text_column, "blob", "found", "base_sha256", "spans")]
    # One blob may be that of a third of all paths; the dice, written before they are used, spread its rows.
    whole = F.struct(*quoted(kept)) if kept else F.lit(0)
    paths = staged(docs.select(whole.alias("path"), blob_id(text_column).alias("blob"), F.rand().alias("dice")), "paths")
    counts = paths.groupBy("blob").agg(F.count("*").alias("rows"))
    named = staged(findings(docs.sparkSession, ledger_path, rule_version).join(counts, "blob"), "named")
    found = spread_join(paths, named, "blob", "rows", "dice")
    return found.select(*(F.col("path").getField(c).alias(c) for c in kept), "blob", "found", "base_sha256", "spans")


def with_spans(
    docs: DataFrame, ledger_path: str | None = None, rule_version: int = RULE_VERSION, name: str = "_found"
) -> DataFrame:
    """All rows of ``docs`` with their text, and in column ``name`` their secrets, null where there are none.

    Only findings meet the documents, and only documents that may have some: a bitmap tells the others, whose texts are not
    moved. Findings are written first, so Spark knows their size: few are broadcast and no text moves at all.
    """
    ledger_path = ledger_path or scratch_path(docs.sparkSession, "ledger")
    scan_new(docs, ledger_path, rule_version=rule_version)
    blob = fresh(docs.columns, "_blob")
    some = findings(docs.sparkSession, ledger_path, rule_version).filter(F.size("found") > 0)
    hits = staged(some.select(F.col("blob").alias(blob), F.col("found").alias(name)), "hits")
    rows, key = docs.withColumn(blob, blob_id()), F.xxhash64(blob)
    may_have = may_be_among(hits.select(key.alias("key")), "key")(key)
    clean = rows.filter(~may_have).withColumn(name, F.lit(None).cast(FOUND))
    return rows.filter(may_have).join(hits, blob, "left").unionByName(clean).drop(blob)


def with_counts(findings: DataFrame) -> DataFrame:
    """``n_assign``, ``n_access`` and ``n_hex`` from ``found``."""

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return findings.withColumns({f"n_{kind}": count(kind) for kind in BASE})


def redacted(text: str, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each span, or run of overlapping spans, replaced by ``mark``."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
