"""Field mapping: whitelist, aliases and list items, compiled from configuration into projections."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def default_mapping(kind: str) -> dict:
    """The expected fields of a type under their own names, list items whole."""
    fields = S.EXPECTED_FIELDS[kind]
    lists = {"bidders": S.BIDDER_FIELDS, "bid_items": S.ITEM_FIELDS}
    mapping = {"mapping_name": f"{kind}_default", "fields": fields, "aliases": {}}
    nested = {name: {"fields": names, "aliases": {}} for name, names in lists.items() if name in fields}
    return {**mapping, "list_fields": nested} if nested else mapping


DEFAULT_MAPPINGS = {kind: default_mapping(kind) for kind in S.EXPECTED_FIELDS}


class MappingConfig:
    """Mappings per document type: explicit file, else FILE_MAPPING_PATH, else the file next to the
    source folder; a missing or unreadable file gives the defaults."""

    def __init__(self, source_dir: str | Path = ".", path: str | None = None):
        folder = Path(source_dir)
        base = folder.parent if folder.name else folder
        chosen = path or os.environ.get("FILE_MAPPING_PATH")
        self.path = Path(chosen) if chosen else base / "file_mappings" / "field_mappings.json"
        self.source = "external" if self.path.exists() else "default"
        self.mappings = self._read()

    def _read(self) -> dict:
        try:
            loaded = json.loads(self.path.read_text(encoding="utf-8"))
        except (OSError, ValueError):
            return DEFAULT_MAPPINGS
        return loaded if isinstance(loaded, dict) else DEFAULT_MAPPINGS

    def of(self, kind: str) -> dict:
        """The mapping of a document type; no mapping is empty."""
        return self.mappings.get(kind) or {}


def _targets(present: Sequence[str], mapping: Mapping) -> dict[str, str]:
    """Output field -> input field. Presence decides, not content: an alias never fills a null."""
    fields = mapping.get("fields", [])
    chosen = {f: f for f in fields if f in present}
    for alias, target in mapping.get("aliases", {}).items():
        if target in fields and alias in present and target not in chosen:
            chosen[target] = alias
    return chosen


def map_items(items: Column, item_fields: Sequence[str], mapping: Mapping) -> Column:
    """Whitelist and alias inside list items; a missing list is empty, null items are dropped."""
    chosen = _targets(item_fields, mapping)
    kept = F.filter(F.coalesce(items, F.array()), lambda x: x.isNotNull())
    return F.transform(kept, lambda x: F.struct(*(x[src].alias(dst) for dst, src in chosen.items())))


def apply_mapping(df: DataFrame, mapping: Mapping, keep: Sequence[str] = ()) -> DataFrame:
    """Project a table of extracted fields onto the mapping; `keep` columns pass through."""
    if not mapping.get("fields"):
        return df
    lists = mapping.get("list_fields", {})
    chosen = {d: s for d, s in _targets(df.columns, mapping).items() if d not in lists}
    columns = [F.col(c) for c in keep] + [F.col(s).alias(d) for d, s in chosen.items()]
    for name, item_mapping in lists.items():
        if name in df.columns:
            element = df.schema[name].dataType.elementType
            columns.append(map_items(F.col(name), element.fieldNames(), item_mapping).alias(name))
        else:
            columns.append(F.array().alias(name))
    return df.select(*columns)


def mapped_data(data: Column, kind: Column, config: MappingConfig) -> Column:
    """The same on the result struct of all document types; fields outside the mapping become null."""
    fields = []
    for field, field_type in S.FIELD_TYPES.items():
        plans = {t: _field_plan(field, t, config) for t in S.EMITTED_FIELDS}
        unchanged = all(
            p == ("as_is", field) or (p[0] == "absent" and field not in S.EMITTED_FIELDS[t]) for t, p in plans.items()
        )
        if unchanged:
            value = data[field]
            listed = [t for t in plans if field in config.of(t).get("list_fields", {})]
            if listed:
                value = F.coalesce(value, F.when(kind.isin(*listed), F.array().cast(field_type)))
        else:
            value = F.lit(None)
            for doc_type, plan in plans.items():
                if plan[0] != "absent":
                    value = F.when(kind == doc_type, _planned(data, field, doc_type, plan, config)).otherwise(value)
        fields.append(value.cast(field_type).alias(field))
    return F.struct(*fields)


def _field_plan(field: str, doc_type: str, config: MappingConfig) -> tuple[str, str]:
    """How a result field is filled for one document type: as_is, from another field, as mapped list, absent."""
    mapping, emitted = config.of(doc_type), S.EMITTED_FIELDS[doc_type]
    if not mapping.get("fields"):
        return ("as_is", field) if field in emitted else ("absent", "")
    if field in mapping.get("list_fields", {}):
        names = T.DataType.fromDDL(S.FIELD_TYPES[field]).elementType.fieldNames()
        chosen = _targets(names, mapping["list_fields"][field])
        whole = all(chosen.get(n) == n for n in names)
        return ("as_is", field) if whole and field in emitted else ("list", field)
    source = _targets(emitted, mapping).get(field)
    if source is None:
        return ("absent", "")
    return ("as_is", field) if source == field else ("from", source)


def _planned(data: Column, field: str, doc_type: str, plan: tuple[str, str], config: MappingConfig) -> Column:
    kind = S.FIELD_TYPES[field]
    if plan[0] != "list":
        return data[plan[1]].cast(kind)
    mapping = config.of(doc_type)
    names = T.DataType.fromDDL(kind).elementType.fieldNames()
    source = data[field] if field in S.EMITTED_FIELDS[doc_type] else F.lit(None).cast(kind)
    return _conform(map_items(source, names, mapping["list_fields"][field]), field, names, mapping).cast(kind)


def _conform(items: Column, field: str, names: Sequence[str], mapping: Mapping) -> Column:
    """Give mapped items the full item struct again, absent members null."""
    chosen = _targets(names, mapping["list_fields"][field])
    element = T.DataType.fromDDL(S.FIELD_TYPES[field]).elementType
    return F.transform(items, lambda x: F.struct(*(
        (x[f.name] if f.name in chosen else F.lit(None)).cast(f.dataType).alias(f.name) for f in element.fields
    )))


def mapping_meta(kind: Column, config: MappingConfig) -> Column:
    """What was applied, per document type: struct(applied, name, source, file, expected_fields)."""
    case = None
    for doc_type in S.EXPECTED_FIELDS:
        mapping = config.of(doc_type)
        applied = bool(mapping.get("fields"))
        meta = F.struct(
            F.lit(applied).alias("applied"),
            F.lit(mapping.get("mapping_name")).cast("string").alias("mapping_name"),
            F.lit(config.source).alias("mapping_source"),
            F.lit(str(config.path)).alias("mapping_file"),
            F.array(*(F.lit(f) for f in mapping.get("fields", []))).cast("array<string>").alias("expected_fields"),
        )
        case = (F if case is None else case).when(kind == doc_type, meta)
    return case
