"""Spark types shared by the operators."""

BLOCK = (
    "struct<seq: int, type: string, text: string, url: string, title: string, subtype: string, heading: string, "
    "items: array<string>, table_index: int, reset_index: int, head: array<array<string>>, body: array<array<string>>, "
    "fields: array<struct<name: string, type: string, format: string>>, references: array<string>, json: string>"
)
PARSED = f"text array<string>, structured_content array<{BLOCK}>"
ENTITY = (
    "struct<entity: string, start: int, end: int, value: string, confidence: double, "
    "groups: array<struct<grp: int, start: int, end: int>>>"
)
FILE_ENTRY = "filename string, input string, path string, status string, time timestamp"
