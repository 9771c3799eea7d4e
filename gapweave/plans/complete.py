"""Fill the missing fields of a target table from the most similar records of a master table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapweave.config import COLUMN_ALIASES, FIELD_LABELS, CompletionConfig
from gapweave.functions.text import combine_fields, is_blank, quoted, truncate_tokens
from gapweave.operators.columns import add_missing_columns, order_output_columns, resolve_aliases
from gapweave.operators.encode import Encoder, embed_texts
from gapweave.operators.knn import (
    BlockLimits,
    cell_count,
    centroid_matrix,
    hash_bits,
    hash_patterns,
    nearest,
    probes_for,
    random_hyperplanes,
    spread_small,
    train_centroids,
)
from gapweave.operators.match import best_matches, fill, lookup_matches
from gapweave.operators.report import completion_report
from gapweave.operators.scoring import MASTER_KEY, TARGET_KEY, LexicalScorer
from gapweave.operators.validate import drop_unusable, require_valid, rows_needing_fill
from gapweave.sources.files import load_typed, normalize_na
from gapweave.sources.sinks import (
    report_document,
    resolve_output,
    save_completed,
    write_json_document,
)
from gapweave.storage import materialize


def record_text(
    fields: Sequence[str], labels: dict[str, str] = FIELD_LABELS, max_tokens: int | None = None
):
    """The text that stands for a record: whole, unless an encoder takes `max_tokens` only."""
    text = combine_fields({labels.get(f, f): quoted(f) for f in fields})
    return truncate_tokens(text, max_tokens) if max_tokens else text


def _as_text(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Logical fields as text, so that an id does not turn into a decimal number."""
    return df.select(*[quoted(c).cast("string").alias(c) if c in fields else quoted(c) for c in df.columns])


def _with_key(df: DataFrame, key: str, label: str) -> DataFrame:
    """Numbered rows, written once: the numbers would change if the table were computed again."""
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), label)


def find_matches(
    master: DataFrame,
    target: DataFrame,
    config: CompletionConfig = CompletionConfig(),
    encoder: Callable[[], Encoder] | None = None,
    limits: BlockLimits = BlockLimits(),
) -> DataFrame:
    """Neighbours of each (target_key, text) among the (master_key, text) rows.

    Without an encoder texts are compared by their token counts. With one, both sides are encoded
    once and stored, since the search reads the vectors more than once.
    """
    if encoder is None and config.index_type.lower() in ("cells", "ivfflat", "hnsw"):
        raise ValueError(f"Index type {config.index_type} works on vectors; give an encoder")
    if encoder is None:
        return nearest(
            target,
            master,
            config.top_k,
            config.threshold,
            config.index_type,
            scorer=LexicalScorer(),
            limits=limits,
        )
    t, m = (
        materialize(
            embed_texts(
                spread_small(df, df.count(), limits).where(~is_blank(F.col("text"))),
                "text",
                encoder,
                config.batch_size,
            ).drop("text"),
            label,
        )
        for df, label in ((target, "target-vectors"), (master, "master-vectors"))
    )
    extra: dict = {"nprobe": config.nprobe, "limits": limits}
    kind = config.index_type.lower()
    if kind in ("cells", "ivfflat"):
        rows = m.count()
        extra["centroids"] = train_centroids(m, rows, cell_count(rows, config.nlist))
        if kind == "ivfflat":
            extra["nprobe"] = probes_for(t, m, centroid_matrix(extra["centroids"]), config.threshold, config.nprobe)
    elif kind == "hnsw":
        first = m.select(F.size("vector").alias("n")).first()
        bits = hash_bits(m.count())
        planes, patterns = random_hyperplanes(first["n"] if first else 1, bits=bits), hash_patterns(bits, config.threshold)
        if len(planes) * len(patterns) < 2**bits:
            extra |= {"hyperplanes": planes, "patterns": patterns}
        else:
            kind = "flat"  # so many probes would compare more pairs than the exact search
    return nearest(t, m, config.top_k, config.threshold, kind, **extra)


def complete(
    master: DataFrame,
    target: DataFrame,
    config: CompletionConfig = CompletionConfig(),
    target_key: str | None = None,
    master_key: str | None = None,
    encoder: Callable[[], Encoder] | None = None,
    aliases: dict[str, Sequence[str]] = COLUMN_ALIASES,
    labels: dict[str, str] = FIELD_LABELS,
    limits: BlockLimits = BlockLimits(),
) -> DataFrame:
    """The target table with its null fields filled where a master record is similar enough.

    Keys name unique, non-null columns; rows of a table without one are numbered and written once.
    """
    fields = list(aliases)
    require_valid(master, "master", aliases)
    require_valid(target, "target", aliases)
    master = drop_unusable(_as_text(resolve_aliases(master, aliases), fields), fields)
    target = _as_text(add_missing_columns(resolve_aliases(target, aliases), fields), fields)
    m_key, t_key = master_key or "_master_row", target_key or "_target_row"
    if master_key is None:
        master = _with_key(master, m_key, "master")
    if target_key is None:
        target = _with_key(target, t_key, "target")
    incomplete = rows_needing_fill(target, fields)
    if incomplete.isEmpty():
        # Nothing is missing: no search, no score columns.
        unchanged = target.drop(t_key) if target_key is None else target
        return order_output_columns(unchanged, config.include_scores, fields)
    text = record_text(fields, labels, config.max_tokens).alias("text")
    neighbours = find_matches(
        master.select(quoted(m_key).alias(MASTER_KEY), text),
        incomplete.select(quoted(t_key).alias(TARGET_KEY), text),
        config,
        encoder,
        limits,
    )
    # The search is the costly step; its result is three narrow columns, kept for the joins.
    best = materialize(best_matches(neighbours), "matches")
    matched = lookup_matches(best, master, m_key, fields)
    filled = fill(target, matched, t_key, fields, config.include_scores)
    if target_key is None:
        filled = filled.drop(t_key)
    return order_output_columns(filled, config.include_scores, fields)


def run_completion(
    spark: SparkSession,
    master_path: str,
    target_path: str,
    output: str | None = None,
    config: CompletionConfig = CompletionConfig(),
    encoder: Callable[[], Encoder] | None = None,
    target_key: str | None = None,
    master_key: str | None = None,
) -> dict:
    """Load both tables, complete the target, save it with its report. Errors are raised."""
    fields = list(COLUMN_ALIASES)
    output = resolve_output(spark, target_path, output, config)
    master = normalize_na(load_typed(spark, master_path, multi_line=config.multi_line))
    target = normalize_na(load_typed(spark, target_path, multi_line=config.multi_line))
    completed = complete(master, target, config, target_key, master_key, encoder)
    written = save_completed(completed, target_path, output, config)
    saved = normalize_na(load_typed(spark, written))
    scores = [c for c in saved.columns if c.endswith("_similarity_score")]
    saved = saved.select(
        *[quoted(c).cast("double").alias(c) if c in scores else quoted(c) for c in saved.columns]
    )
    original = add_missing_columns(resolve_aliases(target), fields)
    report = report_document(completion_report(original, saved, fields))
    report["records"] = report.get("records", {}) | {"master": {"rows": master.count()}, "target": {"rows": target.count()}}
    report["output_file"] = written
    report["configuration"] = config.describe()
    stem = written.rsplit(".", 1)[0]
    report_file = write_json_document(spark, report, f"{stem}_report.json")
    return {"status": "completed", "output_file": written, "report_file": report_file, "statistics": report}
