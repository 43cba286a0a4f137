"""Deterministic ids: name-based UUIDs (version 5) as SHA-1 expressions, without a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespaces of each kind of id.
DNS = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
DOCUMENT = "7c0c3f73-f38d-561e-9405-349c9a112e4e"
ELEMENT = "50cb7cb3-d29d-59a5-b2c7-94447279d9ad"
CHUNK = "7597546f-0abf-5aab-a4aa-1daf1026cddc"
RELATIONSHIP = "58ec3632-99bb-58c9-bfeb-c8c22d9d87e9"
SECTION = "ec99e70b-7e56-5054-bda5-bd1cc95d2a78"
SPAN = "80aa771e-24a4-5001-850e-79ab9a3d900f"
RETRIEVAL_CHUNK = "d7e8f9a0-1234-5678-9abc-def012345678"
# Fixed value: what stands before a section's path in the name of its group.
SAME_SECTION = "docling-project-samesection:"


def uuid5(namespace: str, name: Column) -> Column:
    """The version 5 UUID of a name (UTF-8) in a namespace, as a 36-character string; null for a null name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3),
        F.lit("-"), F.substring(h, 21, 12),
    )


def _name(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def document_id(file_hash: Column) -> Column:
    return uuid5(DOCUMENT, file_hash)


def element_id(doc: Column, page: Column, order: Column, kind: Column) -> Column:
    return uuid5(ELEMENT, _name(doc, page, order, kind))


def chunk_id(doc: Column, kind: Column, path: Column, elements: Column) -> Column:
    return uuid5(CHUNK, _name(doc, kind, path, elements))


def relationship_id(source: Column, target: Column, kind: Column) -> Column:
    return uuid5(RELATIONSHIP, _name(source, target, kind))


def section_id(doc: Column, path: Column, title: Column) -> Column:
    return uuid5(SECTION, _name(doc, path, F.lower(F.trim(title))))


def span_group_id(doc: Column, path: Column, first_page: Column, columns: Column, signature: Column) -> Column:
    return uuid5(SPAN, _name(doc, path, first_page, columns, signature))


def section_group_id(path: Column) -> Column:
    """The id of a section's group of elements; it doesn't depend on the document."""
    return uuid5(DNS, F.concat(F.lit(SAME_SECTION), path))


def retrieval_chunk_id(doc_hash: Column, sequence: Column, types: Column) -> Column:
    """The id of a retrieval chunk: document hash, sequence number (six digits or more) and the sorted types of its items."""
    number = F.when(sequence < 1_000_000, F.lpad(sequence.cast("string"), 6, "0")).otherwise(sequence.cast("string"))
    return uuid5(RETRIEVAL_CHUNK, F.concat(F.lit("doc:"), doc_hash.cast("string"), F.lit("|seq:"), number, F.lit("|types:"), F.array_join(F.array_sort(types), ",")))
