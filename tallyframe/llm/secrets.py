"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by the SHA-256 of its content. The ledger is a
Parquet folder with one row for each blob and rule version that was ever scanned,
with its findings. A run looks only for pairs of blob and rule version that the ledger
lacks, scans each such blob once whatever the number of its paths, adds a segment to the
ledger, and joins findings back to all paths.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import map_batches, plain
from tallyframe.sources import use_checkpoint_dir

FINDINGS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)
LEDGER = T.StructType(
    [
        T.StructField("blob", T.BinaryType()),
        T.StructField("rule", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("findings", FINDINGS),
    ]
)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters.

    ``version`` goes up whenever pattern or limits change; blobs scanned under an older
    version are then scanned again, for this rule alone. ``hint``: plain strings (lower
    case) of which a match holds at least one; texts without them are skipped.
    """

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hints: tuple[str, ...] = ()


#: The kinds that are always scanned, in order.
RULES = (
    Rule(
        "assign", 1,
        "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 6, ("passw", "secret", "token", "api"),
    ),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Rule("hex", 1, "[0-9a-f]{24,}", 0, 24),
)


def find(rule: Rule, compiled: re.Pattern, text: str, lowered: str) -> list[tuple[str, int, int]]:
    """Leftmost matches without overlap, those too short left out; code points, end exclusive."""
    if rule.hints and not any(hint in lowered for hint in rule.hints):
        return []
    return [
        (rule.kind, match.start(), match.end())
        for match in compiled.finditer(text)
        if match.end(rule.group) - match.start(rule.group) >= rule.least
    ]


def content_addresses(versions: DataFrame, path: str, text: str) -> DataFrame:
    """``path``, ``blob`` and ``text`` of every version; a null text is the empty blob."""
    body = F.coalesce(F.col(text), F.lit(""))
    return versions.select(
        F.col(path).alias("path"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("blob"),
        body.alias("text"),
    )


def shared_ledger(spark: SparkSession) -> str:
    """The ledger of all runs that share a checkpoint folder: what one has scanned, the next does not scan."""
    return f"{use_checkpoint_dir(spark).rstrip('/')}/secret-ledger"


def open_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; an empty frame where no segment was written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(ledger)


def scan_versions(
    versions: DataFrame,
    ledger: str,
    path: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Findings of every version: ``path, blob, findings`` (by start, then in order of rules).

    Scans what the ledger at ``ledger`` lacks and adds it there as a new segment. A segment
    is visible only when its write is committed, so a failed run leaves nothing behind
    and the next one starts from the same state; a pair scanned twice by runs at the
    same time is counted once. Null texts are empty, null paths and repeated rows are
    kept, an empty table gives an empty result.
    """
    spark = versions.sparkSession
    addressed = content_addresses(versions, path, text)
    wanted = {(rule.kind, rule.version) for rule in rules}
    current = F.struct("rule", "version").isin(*[F.struct(F.lit(kind), F.lit(version)) for kind, version in sorted(wanted)])
    known = open_ledger(spark, ledger).filter(current)
    done = known.groupBy("blob").agg(F.collect_set("rule").alias("done"))
    # One path stands for its blob. Counting per blob is summed up in each task first.
    blobs = addressed.groupBy("blob").agg(F.min(F.struct("path")).alias("first"))
    due = (
        blobs.join(done, "blob", "left")
        .filter(F.col("done").isNull() | (F.size("done") < len(wanted)))
        .select("blob", F.col("first.path").alias("path"), "done")
    )
    # The side without texts is hashed, the texts stream past it.
    texts = addressed.alias("a").join(
        due.hint("shuffle_hash").alias("d"),
        (F.col("a.blob") == F.col("d.blob")) & F.col("a.path").eqNullSafe(F.col("d.path")),
    ).select("a.blob", "a.text", "d.done")
    compiled = [(rule, plain(rule.pattern)) for rule in rules]

    def each(got: dict[str, list]) -> dict[str, list]:
        made: dict[str, list] = {"blob": [], "rule": [], "version": [], "findings": []}
        for blob, body, done_before in zip(got["blob"], got["text"], got["done"]):
            lowered = body.lower()
            for rule, pattern in compiled:
                if done_before and rule.kind in done_before:
                    continue
                made["blob"].append(blob)
                made["rule"].append(rule.kind)
                made["version"].append(rule.version)
                made["findings"].append(
                    [{"kind": k, "start": s, "end": e} for k, s, e in find(rule, pattern, body, lowered)]
                )
        return made

    segment = f"{ledger.rstrip('/')}/segment-{uuid.uuid4().hex}"
    map_batches(texts, LEDGER, each).write.parquet(segment)
    order = F.create_map(*[F.lit(part) for at, rule in enumerate(rules) for part in (rule.kind, at)])
    found = (
        open_ledger(spark, ledger)
        .filter(current & (F.size("findings") > 0))
        .select("blob", F.explode("findings").alias("f"))
        .distinct()
        .groupBy("blob")
        .agg(F.sort_array(F.collect_list(F.struct("f.start", order[F.col("f.kind")].alias("at"), "f.end", "f.kind"))).alias("findings"))
    )
    paths = addressed.select("path", "blob")
    return paths.join(found, "blob", "left").select(
        "path", "blob", F.coalesce("findings", F.array().cast(found.schema["findings"].dataType)).alias("findings")
    )


def mask_secrets(documents: DataFrame, found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``documents`` with every found span of ``text`` replaced by ``mark``.

    ``found`` is what ``scan_versions`` returned for the same rows, joined by content. Spans
    that overlap are merged. Texts without a finding, null ones too, stay as they are.
    """
    spans = (
        found.filter(F.size("findings") > 0)
        .select("blob", F.transform("findings", lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"))).alias("spans"))
        .dropDuplicates(["blob"])
    )
    kinds = documents.schema
    rest = [field.name for field in kinds]
    addressed = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in rest]).alias("row"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("blob"),
    )
    joined = addressed.join(spans.hint("shuffle_hash"), "blob", "left").select("row.*", F.col("spans").alias("__spans"))

    def each(got: dict[str, list]) -> dict[str, list]:
        texts = [
            masked(body, [(s["start"], s["end"]) for s in spans_of], mark) if spans_of else body
            for body, spans_of in zip(got["text"], got["__spans"])
        ]
        return {name: texts if name == "text" else got[name] for name in rest}

    return map_batches(joined, kinds, each)


def masked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with the union of ``spans`` replaced, each connected part by one mark."""
    parts, at = [], 0
    for start, end in sorted(spans):
        if start < at:
            if end > at:
                at = end
            continue
        parts += [text[at:start], mark]
        at = end
    return "".join(parts) + text[at:]
