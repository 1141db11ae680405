"""Made-up rows that the tests write in every file format."""

import json
from xml.sax.saxutils import escape

# Made-up readings of river gauges: ids and notes are text, one whole and one decimal number, a flag.
READINGS = [
    ("gauge/7", "upper weir", 412, -0.25, False, "ice, thin"),
    ("gauge/12", "mill race", 9, 18.125, True, "clear"),
    ("gauge/3", "old bridge", 77051, 4.0625, True, "high \u00e9t\u00e9 water"),
]
READING_COLUMNS = ["gauge", "site", "flow", "level", "manned", "note"]
READING_TYPES = [("gauge", "string"), ("site", "string"), ("flow", "int"), ("level", "double"), ("manned", "string"), ("note", "string")]


def readings(fmt):
    """The readings as the text of a file."""
    objects = [dict(zip(READING_COLUMNS, r, strict=True)) for r in READINGS]
    texts = [[json.dumps(v) if isinstance(v, bool) else str(v) for v in r] for r in READINGS]
    if fmt == "csv":
        return "\n".join([",".join(READING_COLUMNS)] + [",".join(f'"{v}"' if "," in v else v for v in r) for r in texts])
    if fmt == "tsv":
        return "\n".join("\t".join(r) for r in [READING_COLUMNS, *texts])
    if fmt == "json":
        return json.dumps(objects, indent=1)
    if fmt == "ndjson":
        return "".join(json.dumps(o) + "\n" for o in objects)
    if fmt == "xml":
        body = "".join("<reading>" + "".join(f"<{c}>{escape(v)}</{c}>" for c, v in zip(READING_COLUMNS, r, strict=True)) + "</reading>\n" for r in texts)
        return f"<?xml version='1.0'?><readings>\n{body}</readings>"
    return "\n".join(" ".join(r) for r in texts)
