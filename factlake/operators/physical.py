"""Logical records as bounded physical lines, and back.

A record whose canonical line is too long for a physical line becomes a stub and ordered parts. What form its content takes is
decided by its size: inline, plain, compressed where that is smaller, and beyond the usual limit only for records whose bulk is a list
of affected items, or of one item's ranges. Before that, what a record's owners repeat in each affected item is left out, if the
record can be rebuilt exactly and gets shorter.

All of that is column expressions; only deflating is an Arrow function. Reading back is a fold over sorted parts that holds one
record, checks all it reads and fails at the first thing that doesn't fit: nothing is left out in silence.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import canonical_json, json_string
from ..functions.schemas import with_fields
from .fragments import chunks, deflated

# Fixed values of the format: limits in bytes and parts, names, and the fields that a stub keeps.
LINE_BYTES, PART_BYTES, LEVEL, LEAST = 16384, 8192, 6, 1024
LOGICAL_BYTES, AFFECTED_BYTES = 256 * 1024, 2 * 1024 * 1024
PARTS, AFFECTED_PARTS = 64, 256
PLAIN, AFFECTED, RANGES = "json-utf8-v1", "json-affected-v2", "json-affected-ranges-v4"
DEFLATED = {PLAIN: "json-zlib-v3", AFFECTED: "json-zlib-affected-v3", RANGES: "json-zlib-affected-ranges-v4"}
ENCODING = "cve-indexed-assertions-v1"
STUB = ["schema_version", "record_id", "source_id", "native_id", "kind", "status", "published_at", "source_modified_at", "first_seen_at", "content_hash"]



def _empty() -> Column:
    return F.lit("[]")


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _may_have(line: Column, word: str) -> Column:
    """Whether a JSON text may have a name or string with a word in it: it stands there, or something is escaped. A look at the text
    spares most records being parsed."""
    return line.contains(word) | line.contains("\\u")


def _bytes(v: Column) -> Column:
    """Of a canonical line, with its line feed."""
    return F.octet_length(v) + 1


def logical_format(line: Column) -> Column:
    """The form that a logical record's size allows; null where it is too large for any."""
    v = F.parse_json(line)
    items = _get(v, "$.affected", "array<variant>")
    long = lambda x: _bytes(F.to_json(x)) > LOGICAL_BYTES

    def ranged(x: Column) -> Column:
        ranges = _get(x, "$.original_ranges", "array<variant>")
        fits = F.coalesce(F.size(ranges) > 0, F.lit(False)) & F.forall(ranges, lambda r: _object(r) & ~long(r))
        return fits & (_bytes(with_fields(F.to_json(x), {"original_ranges": _empty()})) <= LOGICAL_BYTES)

    listed = (_bytes(line) <= AFFECTED_BYTES) & (_get(v, "$.kind", "string") == "advisory") & (F.size(items) > 0) & (_bytes(with_fields(line, {"affected": _empty()})) <= LOGICAL_BYTES) & F.forall(items, _object)
    listed = F.coalesce(listed, F.lit(False))
    return F.when(_bytes(line) <= LOGICAL_BYTES, PLAIN).when(listed & ~F.exists(items, long), AFFECTED).when(listed & F.forall(items, lambda x: ~long(x) | ranged(x)), RANGES)


def _without(v: Column, names: list[str]) -> Column:
    """Canonical text of an object without some fields."""
    return canonical_json(F.to_json(F.map_filter(_get(v, "$", "map<string,variant>"), lambda k, _: ~k.isin(names))))


def _owners(v: Column) -> Column:
    """Array of (role, provider, own, at) of a record's assertions: canonical provider, the same without its date, and the places of
    affected items."""
    each = _get(v, "$.assertions", "array<variant>")
    provider = lambda a: _get(a, "$.provider", "variant")
    return F.transform(
        each,
        lambda a: F.struct(
            F.when(F.schema_of_variant(_get(a, "$.role", "variant")) == "STRING", _get(a, "$.role", "string")).alias("role"),
            F.when(_object(provider(a)), F.to_json(provider(a))).alias("provider"),
            F.when(_object(provider(a)), _without(provider(a), ["dateUpdated"])).alias("own"),
            F.when(F.forall(_get(a, "$.affected_indices", "array<variant>"), lambda i: F.schema_of_variant(i) == "BIGINT"), _get(a, "$.affected_indices", "array<bigint>")).alias("at"),
        ),
    )


def _source(owner: Column) -> Column:
    """An assertion's provenance entry."""
    fields = [F.lit('{"independent_evidence":'), (owner["role"] == "cna").cast("string"), F.lit(',"provider":'), owner["provider"], F.lit(',"role":'), json_string(owner["role"]), F.lit(',"source_id":"cve"}')]
    return F.concat(*fields)


def _source_of(owner: Column, i: Column) -> Column:
    return F.concat(F.lit('{"assertion_index":'), i.cast("string"), F.lit(',"independent_evidence":'), (owner["role"] == "cna").cast("string"), F.lit(',"source_id":"cve"}'))


def _texts(v: Column, path: str) -> Column:
    return F.transform(_get(v, path, "array<variant>"), lambda x: F.to_json(x))


def _list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _each_once(owners: Column, items: Column) -> Column:
    at = F.flatten(F.transform(owners, lambda o: o["at"]))
    whole = F.forall(owners, lambda o: o["role"].isNotNull() & o["provider"].isNotNull() & o["at"].isNotNull())
    return whole & (F.size(at) == F.size(items)) & (F.size(F.array_distinct(at)) == F.size(items)) & F.forall(at, lambda i: (i >= 0) & (i < F.size(items)))


def _owner_of(owners: Column, i: Column) -> Column:
    return F.get(F.filter(owners, lambda o: F.array_contains(o["at"], i.cast("bigint"))), F.lit(0))


def compacted(line: Column) -> Column:
    """A record's line without what its assertions say already, with how to rebuild it; the same line where that can't be proven or
    is no shorter."""
    v = F.parse_json(line)
    owners, items, sources = _owners(v), _get(v, "$.affected", "array<variant>"), _texts(v, "$.provenance")
    told = lambda x, i: (_get(x, "$.assertion_role", "string") == _owner_of(owners, i)["role"]) & (F.to_json(_get(x, "$.provider", "variant")) == _owner_of(owners, i)["own"])
    matched = F.forall(F.transform(items, lambda x, i: F.coalesce(_object(x) & told(x, i), F.lit(False))), lambda ok: ok)
    proven = F.size(sources) == F.size(owners) + 1
    proven = proven & _object(F.get(_get(v, "$.provenance", "array<variant>"), F.lit(0))) & F.forall(F.transform(owners, lambda o, i: F.get(sources, i + 1) == _source(o)), lambda ok: ok)
    top = F.to_json(_get(v, "$.descriptions", "variant"))
    said = F.flatten(
        F.transform(
            _get(v, "$.assertions", "array<variant>"),
            lambda a, i: F.filter(
                F.array(*[F.when((_get(a, "$.role", "string") == "cna") & (F.to_json(_get(a, f"$.{f}", "variant")) == top), F.struct(i.alias("i"), F.lit(f).alias("field"))) for f in ("descriptions", "rejectedReasons")]),
                lambda x: x.isNotNull(),
            ),
        )
    )
    first = F.get(said, F.lit(0))
    able = (_get(v, "$.source_id", "string") == "cve") & _get(v, "$.record_encoding", "variant").isNull() & (F.size(owners) > 0) & _each_once(owners, items) & matched & proven & (top.isNull() | first.isNotNull())
    encoding = F.concat(
        F.lit('{"expanded_bytes":'), _bytes(line).cast("string"), F.lit(',"expanded_sha256":"'), F.sha2(F.concat(line, F.lit("\n")), 256), F.lit(f'","format":"{ENCODING}","top_descriptions_assertion_index":'),
        F.when(top.isNull(), "null").otherwise(first["i"].cast("string")), F.lit(',"top_descriptions_source":'), json_string(F.when(top.isNotNull(), first["field"])), F.lit("}"),
    )
    stripped = {
        "affected": _list(F.transform(items, lambda x: _without(x, ["assertion_role", "provider"]))),
        "provenance": _list(F.concat(F.slice(sources, 1, 1), F.transform(owners, lambda o, i: _source_of(o, i)))),
        "record_encoding": encoding,
    }
    short = with_fields(_without(v, ["descriptions"]), stripped)
    return F.when(~_may_have(line, '"assertions"'), line).when(F.coalesce(able, F.lit(False)), F.when(_bytes(short) < _bytes(line), short).otherwise(line)).otherwise(line)


def expanded(line: Column) -> Column:
    """The line that ``compacted`` was given; an error where it can't be rebuilt byte for byte."""
    v = F.parse_json(line)
    encoding = _get(v, "$.record_encoding", "variant")
    size, sha = _get(encoding, "$.expanded_bytes", "bigint"), _get(encoding, "$.expanded_sha256", "string")
    owners, items, sources = _owners(v), _get(v, "$.affected", "array<variant>"), _texts(v, "$.provenance")
    index, field = _get(encoding, "$.top_descriptions_assertion_index", "int"), _get(encoding, "$.top_descriptions_source", "string")
    clean = F.forall(items, lambda x: _object(x) & _get(x, "$.provider", "variant").isNull() & _get(x, "$.assertion_role", "variant").isNull())
    proven = (F.size(sources) == F.size(owners) + 1) & F.forall(F.transform(owners, lambda o, i: F.get(sources, i + 1) == _source_of(o, i)), lambda ok: ok)
    # what is repeated is added up before it is written out
    grows = F.aggregate(owners, F.lit(0).cast("bigint"), lambda n, o: n + F.size(o["at"]) * F.octet_length(o["own"]))
    fits = (_get(encoding, "$.format", "string") == ENCODING) & (size > 0) & (size <= AFFECTED_BYTES) & (grows <= size) & _each_once(owners, items) & clean & proven
    whole = {
        "affected": _list(F.transform(items, lambda x, i: with_fields(F.to_json(x), {"assertion_role": json_string(_owner_of(owners, i)["role"]), "provider": _owner_of(owners, i)["own"]}))),
        "provenance": _list(F.concat(F.slice(sources, 1, 1), F.transform(owners, lambda o: _source(o)))),
    }
    said = F.get(_get(v, "$.assertions", "array<variant>"), index)
    said = F.when(field == "descriptions", _get(said, "$.descriptions", "variant")).when(field == "rejectedReasons", _get(said, "$.rejectedReasons", "variant"))
    plain = with_fields(_without(v, ["record_encoding"]), whole)
    back = F.when(index.isNull() & field.isNull(), plain).when(said.isNotNull() & _get(v, "$.descriptions", "variant").isNull(), with_fields(plain, {"descriptions": F.to_json(said)}))
    good = F.coalesce(fits, F.lit(False))
    rebuilt = F.when(good, back)
    same = (_bytes(rebuilt) == size) & (F.sha2(F.concat(rebuilt, F.lit("\n")), 256) == sha)
    failed = F.raise_error(F.concat(F.lit("a compact record can't be rebuilt: "), F.coalesce(_get(v, "$.record_id", "string"), F.lit("?"))))
    return F.when(~_may_have(line, '"record_encoding"'), line).when(encoding.isNull(), line).when(F.coalesce(same, F.lit(False)), rebuilt).otherwise(failed)


def _part(v: Column, payload: Column, index: Column, total: Column) -> Column:
    """A part's canonical line."""
    text = lambda name: F.to_json(_get(v, f"$.{name}", "variant"))
    number = F.lpad(index.cast("string"), 3, "0")
    ident, native = (json_string(F.concat(_get(v, f"$.{c}", "string"), F.lit("/part/"), number)) for c in ("record_id", "native_id"))
    sha = F.concat(F.lit('"'), F.sha2(payload, 256), F.lit('"'))
    encoded = F.concat(F.lit('"'), F.regexp_replace(F.base64(payload), "[\\r\\n]", ""), F.lit('"'))
    fields = {
        "affected": _empty(), "aliases": _empty(), "chunk_sha256": sha, "content_hash": sha, "first_seen_at": text("first_seen_at"), "kind": F.lit('"continuation"'), "native_id": native, "parent_record_id": text("record_id"),
        "part_index": index.cast("string"), "payload_base64": encoded, "provenance": _empty(), "published_at": F.lit("null"), "record_id": ident, "references": _empty(), "schema_version": text("schema_version"),
        "source_id": text("source_id"), "source_modified_at": F.lit("null"), "status": F.lit('"fragment"'), "title": ident, "total_parts": total.cast("string"),
    }
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), x) for k, x in fields.items()]), F.lit("}"))


def passes(line: Column) -> Column:
    """Whether a line is its own physical form for certain: short, and never shorter if packed or compacted, as a stub and a part alone
    take more than ``LEAST`` bytes."""
    few = (F.get_json_object(line, "$.source_id") != "cve") | ((_bytes(line) <= LEAST) & ~line.contains('"assertions"'))
    return F.coalesce((_bytes(line) <= LINE_BYTES) & few, F.lit(False))


def physical(rows: DataFrame) -> DataFrame:
    """``rows`` (record_id, line: canonical JSON, and others) with a row for each physical line: record_id, line, part_index (null for
    a stub or an inline record). A record that fits no form fails the job. Short records that are never packed pass as they are."""
    others = [c for c in rows.columns if c not in ("record_id", "line")]
    short = passes(F.col("line"))
    passed = rows.filter(short).select("record_id", *others, "line", F.lit(None).cast("int").alias("part_index"))
    rows = rows.filter(~short).withColumn("format", logical_format(F.col("line"))).withColumn("stored", compacted(F.col("line")))
    data = F.concat("stored", F.lit("\n")).cast("binary")
    cve = F.get_json_object("line", "$.source_id") == "cve"
    rows = rows.withColumn("packed", deflated(F.when(cve, data)))
    shrunk = F.coalesce(F.octet_length("packed") < F.octet_length(data), F.lit(False))
    names = F.col("format")
    for plain, short in DEFLATED.items():
        names = F.when(shrunk & (F.col("format") == plain), short).otherwise(names)
    most = F.when(F.col("format") == PLAIN, PARTS).otherwise(AFFECTED_PARTS)
    rows = rows.withColumns({"data": data, "payload": F.when(shrunk, F.col("packed")).otherwise(data), "shrunk": shrunk, "name": names, "most": most, "v": F.parse_json("stored")}).drop("packed")
    v = F.col("v")  # parsed once for each record, not for each field of each part
    room = F.lit(LINE_BYTES) - _bytes(_part(v, F.lit(b""), F.col("most") - 1, F.col("most")))
    rows = rows.withColumn("chunk", F.least(F.lit(PART_BYTES), F.floor(room / 4).cast("int") * 3)).withColumn("total", F.when(F.col("chunk") > 0, F.ceil(F.octet_length("payload") / F.col("chunk")).cast("int")))
    usable = F.coalesce(F.col("total") <= F.col("most"), F.lit(False))
    parts = F.transform(F.filter(chunks(F.col("payload"), F.col("chunk")), lambda _: usable), lambda c: F.struct(c["part_index"].alias("part_index"), _part(v, c["payload"], c["part_index"], F.col("total")).alias("line")))
    rows = rows.withColumn("parts", F.when(usable, parts))
    idents = F.transform(F.sequence(F.lit(0), F.col("total") - 1), lambda i: json_string(F.concat("record_id", F.lit("/part/"), F.lpad(i.cast("string"), 3, "0"))))
    sha = lambda x: F.concat(F.lit('"'), F.sha2(x, 256), F.lit('"'))
    told = {"format": json_string(F.col("name")), "parts": _list(idents), "bytes": F.octet_length("data").cast("string"), "sha256": sha("data"), "requires_reassembly": F.lit("true")}
    counted = {"affected_count": F.size(_get(v, "$.affected", "array<variant>")).cast("string")}
    packed = {"compression": F.lit('"zlib"'), "compression_level": F.lit(str(LEVEL)), "compressed_bytes": F.octet_length("payload").cast("string"), "compressed_sha256": sha("payload")}
    object_ = lambda *ds: F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), x) for d in ds for k, x in d.items()]), F.lit("}"))
    listed = F.col("format") != PLAIN
    descriptor = F.when(listed & F.col("shrunk"), object_(told, counted, packed)).when(listed, object_(told, counted)).when(F.col("shrunk"), object_(told, packed)).otherwise(object_(told))
    known = F.map_filter(_get(v, "$", "map<string,variant>"), lambda k, _: k.isin(STUB))
    kept, usable = F.to_json(known), usable & (F.size(known) == len(STUB))
    stub = with_fields(kept, {"title": F.to_json(_get(v, "$.native_id", "variant")), **{c: _empty() for c in ("aliases", "affected", "references", "provenance")}, "continuation": descriptor})
    rows = rows.withColumn("stub", F.when(usable, stub))
    total = F.aggregate("parts", _bytes(F.col("stub")).cast("bigint"), lambda n, p: n + _bytes(p["line"]))
    split = F.coalesce((_bytes(F.col("stub")) <= LINE_BYTES) & F.forall("parts", lambda p: _bytes(p["line"]) <= LINE_BYTES), F.lit(False))
    inline = (F.octet_length("data") <= LINE_BYTES) & ~(split & F.col("shrunk") & (total < F.octet_length("data")))
    failed = F.raise_error(F.concat(F.lit("a record fits no physical form: "), "record_id")).cast("array<struct<part_index:int,line:string>>")
    one = lambda x: F.array(F.struct(F.lit(None).cast("int").alias("part_index"), x.alias("line")))
    lines = F.when(F.col("format").isNotNull() & inline, one(F.col("stored"))).when(F.col("format").isNotNull() & split, F.concat(one(F.col("stub")), F.col("parts"))).otherwise(failed)
    out = rows.select(F.col("record_id").alias("of"), *others, F.inline(lines))
    ident = F.when(F.col("part_index").isNull(), F.col("of")).otherwise(F.concat("of", F.lit("/part/"), F.lpad(F.col("part_index").cast("string"), 3, "0")))
    return passed.unionByName(out.select(ident.alias("record_id"), *others, "line", "part_index"))


def _canonical(value: object) -> bytes:
    return (json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")) + "\n").encode()


def _stub_of(row: dict) -> dict:
    return {k: row[k] for k in STUB} | {"title": row["native_id"], "aliases": [], "affected": [], "references": [], "provenance": []}


class _Open:
    """A record whose parts are being read."""

    def __init__(self, ident: str, line: str):
        self.ident, self.stub = ident, json.loads(line)
        d = self.about = self.stub["continuation"]
        self.packed, listed = d["format"] in DEFLATED.values(), "affected_count" in d
        self.most = AFFECTED_BYTES if listed else LOGICAL_BYTES
        self.size = d["compressed_bytes"] if self.packed else d["bytes"]
        self.check(len(line.encode()) < LINE_BYTES and d["format"] in (*DEFLATED, *DEFLATED.values()) and listed == (d["format"] not in (PLAIN, DEFLATED[PLAIN])) and d["requires_reassembly"] is True, "descriptor")
        fields = {"format", "parts", "bytes", "sha256", "requires_reassembly"} | ({"affected_count"} if listed else set()) | ({"compression", "compression_level", "compressed_bytes", "compressed_sha256"} if self.packed else set())
        self.check(set(d) == fields and (not self.packed or (d["compression"], d["compression_level"]) == ("zlib", LEVEL)), "descriptor")
        self.check(d["parts"] == [f"{ident}/part/{i:03d}" for i in range(len(d["parts"]))] and 0 < len(d["parts"]) <= (AFFECTED_PARTS if listed else PARTS), "list of parts")
        self.check(0 < d["bytes"] <= self.most and 0 < self.size <= self.most, "size")
        self.data, self.next = bytearray(), 0

    def check(self, holds: bool, what: str) -> None:
        if not holds:
            raise ValueError(f"damaged record {self.ident}: {what}")

    def add(self, ident: str, line: str) -> None:
        self.check(self.next < len(self.about["parts"]) and ident == self.about["parts"][self.next], "parts repeat, lack or don't belong")
        part = json.loads(line)
        payload = base64.b64decode(part["payload_base64"], validate=True)
        sha, stub = hashlib.sha256(payload).hexdigest(), self.stub
        native = f"{stub['native_id']}/part/{self.next:03d}"
        want = {
            "schema_version": stub["schema_version"], "record_id": ident, "source_id": stub["source_id"], "native_id": native, "kind": "continuation", "status": "fragment", "title": ident, "aliases": [], "published_at": None,
            "source_modified_at": None, "first_seen_at": stub["first_seen_at"], "affected": [], "references": [], "provenance": [], "content_hash": sha, "parent_record_id": self.ident, "part_index": self.next,
            "total_parts": len(self.about["parts"]), "payload_base64": base64.b64encode(payload).decode(), "chunk_sha256": sha,
        }
        self.check(bool(payload) and part == want and len(line.encode()) < LINE_BYTES, f"part {self.next}")
        self.data += payload
        self.check(len(self.data) <= self.size, "more bytes than it says")
        self.next += 1

    def close(self) -> tuple[str, str, str, int | None]:
        d, data = self.about, bytes(self.data)
        self.check(self.next == len(d["parts"]) and len(data) == self.size, "parts are missing")
        if self.packed:
            self.check(hashlib.sha256(data).hexdigest() == d["compressed_sha256"], "compressed digest")
            inflate = zlib.decompressobj()
            try:
                data = inflate.decompress(data, d["bytes"] + 1)  # never more than it says, whatever the payload holds
            except zlib.error as e:
                self.check(False, str(e))
            self.check(len(data) <= d["bytes"] and inflate.eof and not inflate.unconsumed_tail and not inflate.unused_data, "compressed content")
        self.check(len(data) == d["bytes"] and hashlib.sha256(data).hexdigest() == d["sha256"], "digest")
        row = json.loads(data)
        self.check(type(row) is dict and row.get("kind") != "continuation" and "continuation" not in row and _canonical(row) == data, "content")
        self.check(all(k in row for k in STUB) and _stub_of(row) | {"continuation": d} == self.stub, "identity")
        return self.ident, data[:-1].decode(), d["format"], d.get("affected_count")


def _folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (place, of, record_id, part_index, line) in order, stubs before their parts: one record is held at a time."""
    now: _Open | None = None
    place = None
    for frame in frames:
        out = []
        for at, of, ident, index, line in zip(frame["place"], frame["of"], frame["record_id"], frame["part_index"], frame["line"], strict=True):
            if index < 0:
                if now:
                    out.append((place, *now.close()))
                now, place = _Open(ident, line), at
            elif now is None or now.ident != of or place != at:
                raise ValueError(f"a part without its record: {ident}")
            else:
                now.add(ident, line)
        yield pd.DataFrame(out, columns=["place", "record_id", "line", "format", "affected_count"]).astype({"affected_count": "Int64"})
    if now:
        yield pd.DataFrame([(place, *now.close())], columns=["place", "record_id", "line", "format", "affected_count"]).astype({"affected_count": "Int64"})


def logical(lines: DataFrame, place: str | None = None) -> DataFrame:
    """The logical records (place, record_id, line) of physical ``lines`` (record_id, line); parts never span two values of the column
    ``place`` (a number). Inline records are not shuffled. Parts that repeat, lack, belong nowhere or are damaged fail the read."""
    at = F.col(place).cast("long") if place else F.lit(0).cast("long")
    told = lambda path: F.when(_may_have(F.col("line"), "continuation"), F.get_json_object("line", path))
    rows = lines.select(at.alias("place"), "record_id", "line", told("$.kind").alias("kind"), told("$.continuation").isNotNull().alias("stub"))
    part = F.coalesce(F.col("kind") == "continuation", F.lit(False))
    inline = rows.filter(~part & ~F.col("stub")).select("place", "record_id", "line", F.lit(None).cast("string").alias("format"), F.lit(None).cast("long").alias("affected_count"))
    long = F.when(_bytes(F.col("line")) > LINE_BYTES, F.raise_error(F.concat(F.lit("a physical line is too long: "), "record_id"))).otherwise(F.col("line"))
    of = F.when(part, F.get_json_object("line", "$.parent_record_id")).otherwise(F.col("record_id"))
    index = F.when(part, F.get_json_object("line", "$.part_index").cast("int")).otherwise(-1)
    apart = rows.filter(part | F.col("stub")).select("place", of.alias("of"), "record_id", F.coalesce(index, F.lit(1 << 30)).alias("part_index"), "line")
    ordered = apart.repartition("place", "of").sortWithinPartitions("place", "of", "part_index", "record_id")
    whole = ordered.mapInPandas(_folded, "place long, record_id string, line string, format string, affected_count long")
    both = inline.withColumn("line", long).unionByName(whole).withColumn("stored", F.col("line")).withColumn("line", expanded(F.col("stored")))
    fits = logical_format(F.col("line"))
    form = F.col("format")
    for plain, short in DEFLATED.items():
        form = F.when(F.col("format") == short, plain).otherwise(form)
    items = F.size(_get(F.parse_json("line"), "$.affected", "array<variant>"))
    good = fits.isNotNull() & (F.col("format").isNull() | ((form == fits) & F.when(F.col("affected_count").isNull(), True).otherwise(F.col("affected_count") == items)))
    checked = F.when(F.coalesce(good, F.lit(False)), F.col("line")).otherwise(F.raise_error(F.concat(F.lit("a record's form doesn't fit its size: "), "record_id")))
    return both.select("place", "record_id", checked.alias("line"))
