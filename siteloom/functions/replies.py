"""Model replies as text: blocks, the JSON object in them, and what to do without one. Numbers are read as text first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siteloom.functions.scalars import confidence

REPLY = (
    "site_type string, site_confidence string, site_evidence string, asset_box_2d array<string>, asset_view string, "
    "cell_equipment boolean, cell_equipment_confidence string, cell_equipment_evidence string"
)
SCAN = "candidates array<struct<box_2d: array<string>, reason: string>>"


def json_part(text: Column) -> Column:
    """From the first brace to the last, or the whole text."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(found == "", text).otherwise(found)


def parse(text: Column, schema: str) -> Column:
    """A struct of ``schema``, or null where the text holds no such object."""
    got = F.from_json(json_part(text), f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    fields = [x.strip().split(" ")[0] for x in _fields(schema)]
    return F.when(got.isNotNull() & got["_bad"].isNull(), F.struct(*[got[f].alias(f) for f in fields]))


def _fields(schema: str) -> list[str]:
    out, depth = [""], 0
    for c in schema:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def reply(text: Column) -> dict[str, Column]:
    """The reply's fields; an unreadable one is unclear with confidence 0 and says so."""
    got = parse(text, REPLY)
    lost = got.isNull()
    return {
        "site_type": F.when(lost, "unclear").otherwise(got.site_type),
        "site_confidence": F.when(lost, F.lit(0.0)).otherwise(confidence(got.site_confidence)),
        "site_evidence": F.when(lost, unreadable(text)).otherwise(got.site_evidence),
        "asset_box_2d": got.asset_box_2d, "asset_view": got.asset_view, "cell_equipment": got.cell_equipment,
        "cell_equipment_confidence": confidence(got.cell_equipment_confidence), "cell_equipment_evidence": got.cell_equipment_evidence,
    }


def unreadable(text: Column) -> Column:
    return F.concat(F.lit("unparseable model reply: "), F.substring(F.coalesce(text, F.lit("")), 1, 200))


def block_text(blocks: Column, tool: str) -> Column:
    """blocks: array of struct(type, name, input, text). The first input of the tool, else all texts joined."""
    tools = F.filter(blocks, lambda b: (b["type"] == "tool_use") & (b["name"] == tool) & b["input"].isNotNull())
    said = F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"])
    return F.coalesce(F.get(tools, F.lit(0))["input"], F.array_join(said, ""))
