"""Settings of the two pipelines, passed explicitly; there is no module-level instance."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# The columns of a raw extract and the names they get.
REQUIRED_COLUMNS = (
    "Equipment",
    "Equipment description",
    "Created on",
    "Chngd On",
    "ObjectType",
    "Manufacturer of Asset",
)
COLUMN_MAPPINGS = {
    "Equipment": "equipment_number",
    "Equipment description": "Equipment Description",
    "Created on": "created_on",
    "Chngd On": "changed_on",
    "ObjectType": "Equipment Type",
    "Manufacturer of Asset": "manufacturer",
}

# Accepted names of the two logical columns, in order of preference.
COLUMN_ALIASES = {
    "equipment_type": ("Equipment Type", "ObjectType", "equipment_type", "equip_type"),
    "equipment_description": (
        "Equipment Description",
        "equipment_description",
        "description",
        "desc",
    ),
}
FIELDS = tuple(COLUMN_ALIASES)

# Words put before each field in the text that gets compared.
FIELD_LABELS = {"equipment_type": "Type", "equipment_description": "Description"}

DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "dd.MM.yyyy",
)

INDEX_TYPES = ("flat", "prefix", "cells", "ivfflat", "hnsw")
OUTPUT_FORMATS = ("csv", "parquet", "json")


@dataclass(frozen=True)
class ConsolidationConfig:
    required_columns: tuple[str, ...] = REQUIRED_COLUMNS
    column_mappings: dict[str, str] = field(default_factory=lambda: dict(COLUMN_MAPPINGS))
    date_columns: tuple[str, ...] = ("created_on", "changed_on")
    date_formats: tuple[str, ...] = DATE_FORMATS
    remove_duplicates: bool = True
    remove_empty_rows: bool = False
    narrow_types: bool = True
    save_csv: bool = True
    save_parquet: bool = True
    # CSV with line breaks in quotes; False lets large files be split.
    multi_line: bool = True
    # Leave damaged files out, whole and named in the report, instead of failing.
    skip_corrupt: bool = False
    # Put rows that do not fit their file's layout, also those read in part, into a table beside the output.
    quarantine: bool = False

    def __post_init__(self):
        if not self.required_columns:
            raise ValueError("required_columns must not be empty")
        if not self.date_formats:
            raise ValueError("date_formats must not be empty")

    def describe(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class CompletionConfig:
    threshold: float = 0.75
    top_k: int = 1
    index_type: str = "flat"
    # Cells of the cell index; None lets them grow with the root of the rows.
    nlist: int | None = None
    nprobe: int = 8
    batch_size: int = 16
    max_tokens: int | None = None
    include_scores: bool = True
    output_format: str = "csv"
    backup_original: bool = True
    overwrite: bool = False
    multi_line: bool = True

    def __post_init__(self):
        if not 0.0 <= self.threshold <= 1.0:
            raise ValueError(f"threshold must lie in [0, 1], got {self.threshold}")
        for name in ("top_k", "nlist", "nprobe", "batch_size"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive, got {getattr(self, name)}")
        if self.max_tokens is not None and self.max_tokens <= 0:
            raise ValueError(f"max_tokens must be positive, got {self.max_tokens}")
        if self.output_format not in OUTPUT_FORMATS:
            raise ValueError(f"output_format must be one of {OUTPUT_FORMATS}, got {self.output_format}")

    def describe(self) -> dict:
        return asdict(self)
