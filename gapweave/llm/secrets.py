"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds one row per blob and rule
version with the secrets found; only pairs it lacks are scanned, and findings are joined back to all paths.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPANS = "array<struct<start:bigint,kind_order:int,kind:string,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern`; those whose `group` is shorter than `least` are dropped.

    `hints`: lower-case texts of which a content must hold one, else the pattern is not run.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    hints: tuple[str, ...] = ()
    base: bool = False
    flags: int = re.ASCII
    compiled: re.Pattern = field(init=False, compare=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "compiled", re.compile(self.pattern, self.flags))

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        for match in self.compiled.finditer(text):
            if match.end(self.group) - match.start(self.group) >= self.least:
                yield match.span()


# The base patterns. `[0-9a-f]{24,}` finds what `[0-9a-f]+` of 24 or more finds.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=1,
        least=6,
        hints=("password", "passwd", "secret", "token", "apikey", "api_key"),
        base=True,
        flags=re.ASCII | re.IGNORECASE,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20, hints=("akia",), base=True),
    Rule("hex", "[0-9a-f]{24,}", base=True),
)
# A key is found up to its END line; without one, to the end of the header lines and base64 lines that follow. Each loop
# ends where it must, so it gives nothing back (`*+`, `++`) and no state is kept for each character.
_PRIVATE_KEY = (
    r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY((?: BLOCK)?)-----"
    r"(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END \1PRIVATE KEY\2-----"
    r"|(?:\s*[A-Za-z][A-Za-z-]*:[^\r\n]*(?:\r?\n|$))*+"
    r"(?:(?:(?:\s|\\[rn])*+[A-Za-z0-9+/=]{40,}+)++(?:[ \t]*(?:\r?\n|\\n)[A-Za-z0-9+/=]+[ \t]*(?=\r?\n|\\n|$))*+)?)"
)
EXTRA_RULES = (
    Rule("private_key", _PRIVATE_KEY, hints=("private key",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)
RULES = BASE_RULES + EXTRA_RULES


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    """Names a set of rules; any change of a rule gives another version, and so a scan of all blobs."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def find_spans(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, str, int]]:
    """(start, order of the kind, kind, end) in code points, sorted."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    found = [
        (start, order, rule.kind, end)
        for order, rule in enumerate(rules)
        if not rule.hints or any(hint.encode() in raw for hint in rule.hints)
        for start, end in rule.spans(text)
    ]
    return sorted(found)


def _scanner(rules: tuple[Rule, ...]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = ("start", "kind_order", "kind", "end")
            spans = [[dict(zip(names, s)) for s in find_spans(text, rules)] for text in frame["content"]]
            yield pd.DataFrame({"blob": frame["blob"], "spans": spans})

    return run


class Ledger:
    """A folder of Parquet files: blob, spans; one subfolder per rule version, one below it per run.

    A run appears in the ledger when its write is committed, so a lost executor or a failed run leaves nothing half
    done. Runs at the same time may both scan a blob; they find the same.
    """

    def __init__(self, spark, path: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.rules = spark, rules
        self.path = f"{path.rstrip('/')}/rules-{rule_version(rules)}"

    def rows(self) -> DataFrame:
        schema = f"blob binary, spans {_SPANS}"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/run-*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def scan(self, versions: DataFrame) -> None:
        """Scans blobs of `versions` (path, content, blob) that the ledger lacks, each once, and adds them."""
        unseen = (
            versions.groupBy("blob").agg(F.min(F.struct("path")).alias("first")).join(self.rows(), "blob", "left_anti")
        )
        # Contents move by path and blob, so a blob with very many paths moves once and is not gathered anywhere.
        picked = versions.alias("v").join(
            unseen.select("blob", F.col("first.path").alias("path")).alias("u"),
            F.col("v.path").eqNullSafe(F.col("u.path")) & (F.col("v.blob") == F.col("u.blob")),
            "left_semi",
        )
        found = picked.select("blob", "content").mapInPandas(_scanner(self.rules), f"blob binary, spans {_SPANS}")
        found.write.parquet(f"{self.path}/run-{uuid.uuid4().hex}")


def blob(content: Column) -> Column:
    """The address of a content."""
    return F.unhex(F.sha2(F.encode(content, "UTF-8"), 256))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, by start and then kind, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def scan_secrets(
    docs: DataFrame,
    ledger_path: str,
    rules: tuple[Rule, ...] = RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Scans what the ledger lacks; returns id, blob and `spans` (array of start, kind_order, kind, end) of every row.

    A row is one version of a path: repeated and null ids are kept, each with the findings of its own content. A
    null text counts as empty. Spans of different kinds may overlap. Other columns are ignored.
    """
    content = F.coalesce(F.col(text_column), F.lit(""))
    versions = docs.select(F.col(id_column).alias("path"), content.alias("content"), blob(content).alias("blob"))
    ledger = Ledger(docs.sparkSession, ledger_path, rules)
    ledger.scan(versions)
    findings = ledger.rows().where(F.size("spans") > 0).dropDuplicates(["blob"])
    joined = versions.select("path", "blob").join(findings, "blob", "left")
    return joined.select(
        F.col("path").alias(id_column), "blob", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans")
    )


def redact_documents(
    docs: DataFrame,
    ledger_path: str,
    rules: tuple[Rule, ...] = RULES,
    mark: str = "[secret]",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All rows and columns of `docs`, with the secrets in the texts replaced by `mark`.

    Findings are joined by id and content, so repeated and null ids are treated by their own texts and copies
    spread. Null texts stay null. Columns named `_blob` or `_spans` are refused.
    """
    if clash := {"_blob", "_spans"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns already there: {sorted(clash)}")
    found = scan_secrets(docs, ledger_path, rules, id_column, text_column).where(F.size("spans") > 0)
    found = found.select(F.col(id_column).alias("_id"), F.col("blob").alias("_found"), F.col("spans").alias("_spans"))
    keyed = docs.withColumn("_blob", blob(F.coalesce(F.col(text_column), F.lit(""))))
    joined = keyed.join(
        found.dropDuplicates(["_id", "_found"]),
        F.col(id_column).eqNullSafe(F.col("_id")) & (F.col("_blob") == F.col("_found")),
        "left",
    )
    clean = F.when(F.col("_spans").isNull(), F.col(text_column)).otherwise(redact(F.col(text_column), F.col("_spans"), mark))
    return joined.withColumn(text_column, clean).select(*docs.columns)


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every maximal run of overlapping spans replaced by `mark`."""

    def step(acc: Column, span: Column) -> Column:
        inside = span["start"] < acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (span["start"] - acc["at"]).cast("int"))
        return F.struct(
            F.greatest(acc["at"], span["end"]).alias("at"),
            F.when(inside, acc["parts"]).otherwise(F.concat(acc["parts"], F.array(gap, F.lit(mark)))).alias("parts"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    rest = lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))
    )
    return F.when(F.size(spans) > 0, F.aggregate(F.array_sort(spans), start, step, rest)).otherwise(text)
