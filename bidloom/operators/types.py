"""Document types as specifications: how a type is recognised, which fields it yields and how they are found.

The document plan is put together from the registered specifications. The six built-in types are registered here in the same form as a
user's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from . import classify, fields, groups, mapping

Words = Sequence[Sequence[str]]


@dataclass(frozen=True)
class DocumentType:
    """One type of document.

    `filename` and `content` are groups of words: every group needs one of its words in the file name or first page. `expected` are the
    fields that completeness counts and the default mapping keeps, `emitted` those that extraction yields (by default these and the lists). `scalars(text, file_name)` gives columns
    by field name, `bidders(text)` and `bid_items(text, tables)` the lists. `new_fields` declares fields that no other type has
    (name: type) and `new_columns` those of them that the contracts table gets (name: type). `key_by_page`: the key of a document with
    lists is looked for page by page. `second_text`: a blank text is replaced by that of a second reader, if there is one."""

    name: str
    method: str
    scalars: Callable[[Column, Column], dict[str, Column]]
    expected: Sequence[str]
    filename: Words = ()
    content: Words = ()
    emitted: Sequence[str] | None = None
    bidders: Callable[[Column], Column] | None = None
    bid_items: Callable[[Column, Column], Column] | None = None
    new_fields: dict[str, str] = field(default_factory=dict)
    new_columns: dict[str, str] = field(default_factory=dict)
    key_by_page: bool = False
    second_text: bool = False

    def extracted(self, text: Column, file_name: Column, tables: Column) -> dict[str, Column]:
        found = dict(self.scalars(text, file_name))
        if self.bidders:
            found["bidders"] = self.bidders(text)
        if self.bid_items:
            found["bid_items"] = self.bid_items(text, tables)
        return {f: c for f, c in found.items() if f in S.EMITTED_FIELDS[self.name]}


TYPES: dict[str, DocumentType] = {}


def _no_items(text: Column, tables: Column) -> Column:
    return F.array()


def _built_in(name: str, **more) -> None:
    TYPES[name] = DocumentType(
        name, S.EXTRACTION_METHOD[name], partial(fields.scalar_fields, name), S.EXPECTED_FIELDS[name], emitted=S.EMITTED_FIELDS[name], **more)


_built_in(S.INVITATION)
_built_in(S.AWARD)
_built_in(S.BID_TABS, bidders=partial(groups.bidders, S.BID_TABS), bid_items=groups.bid_tab_items, key_by_page=True)
_built_in(S.ITEM_C, bidders=partial(groups.bidders, S.ITEM_C))
_built_in(S.AS_READ, bidders=partial(groups.bidders, S.AS_READ), bid_items=_no_items, second_text=True)
_built_in(S.SUMMARY, bidders=partial(groups.bidders, S.SUMMARY), bid_items=_no_items, second_text=True)


def register(kind: DocumentType) -> None:
    """Add a type to the document plan, after those there are: its rules come last, so no document changes its type by it unless it was
    unknown. Names and fields that are taken are refused."""
    if kind.name in TYPES or kind.name == S.UNKNOWN:
        raise ValueError(f"there is a document type {kind.name} already")
    if taken := [f for f in kind.new_fields if f in S.FIELD_TYPES]:
        raise ValueError(f"there are fields {taken} already")
    known = S.FIELD_TYPES.keys() | kind.new_fields.keys()
    if unknown := [f for f in (*kind.expected, *(kind.emitted or ()), *kind.new_columns) if f not in known]:
        raise ValueError(f"fields {unknown} of {kind.name} are not declared")
    if not kind.filename and not kind.content:
        raise ValueError(f"{kind.name} has no rule to recognise it by")
    S.SCALAR_TYPES.update(kind.new_fields)
    S.FIELD_TYPES.update(kind.new_fields)
    S.CONTRACT_COLUMNS.update(kind.new_columns)
    S.EXPECTED_FIELDS[kind.name] = list(kind.expected)
    lists = [name for name, made in (("bidders", kind.bidders), ("bid_items", kind.bid_items)) if made]
    S.EMITTED_FIELDS[kind.name] = list(kind.emitted or dict.fromkeys([*kind.expected, *lists]))
    S.EXTRACTION_METHOD[kind.name] = kind.method
    mapping.DEFAULT_MAPPINGS[kind.name] = mapping.default_mapping(kind.name)
    if kind.filename:
        classify.FILENAME_RULES.append((kind.name, kind.filename))
    if kind.content:
        classify.CONTENT_RULES.append((kind.name, kind.content))
    TYPES[kind.name] = kind


def unregister(name: str) -> None:
    """Take a type that was registered out again."""
    kind = TYPES.pop(name)
    for table in (S.EXPECTED_FIELDS, S.EMITTED_FIELDS, S.EXTRACTION_METHOD, mapping.DEFAULT_MAPPINGS):
        table.pop(name, None)
    for f in kind.new_fields:
        S.SCALAR_TYPES.pop(f, None)
        S.FIELD_TYPES.pop(f, None)
    for f in kind.new_columns:
        S.CONTRACT_COLUMNS.pop(f, None)
    for rules in (classify.FILENAME_RULES, classify.CONTENT_RULES):
        rules[:] = [r for r in rules if r[0] != name]


@contextmanager
def registered(kind: DocumentType) -> Iterator[DocumentType]:
    """The type is part of plans that are built inside."""
    register(kind)
    try:
        yield kind
    finally:
        unregister(kind.name)
