"""JSON documents as structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Readers of JSON lines, pages and CSV take this: what does not fit stops the run.
STRICT = {"mode": "FAILFAST"}

_BROKEN = "__broken"


def parsed(document: str, schema: str) -> Column:
    """The document in column ``document``, with the fields of ``schema``.

    Text that is no JSON, such as a document cut short, stops the query. A field of another
    kind than expected is NULL, as where a path finds nothing; blank text is a NULL document.
    """
    struct = F.from_json(
        document, f"{schema}, {_BROKEN} STRING", {"columnNameOfCorruptRecord": _BROKEN}
    )

    def checked(found: Column) -> Column:
        text = found[_BROKEN]
        message = F.concat(F.lit("document does not parse: "), F.left(text, F.lit(200)))
        is_broken = text.isNotNull() & F.get_json_object(text, "$").isNull()
        return F.when(is_broken, F.raise_error(message)).otherwise(found)

    # The array has the document parsed once for the check and the fields.
    return F.get(F.transform(F.array(struct), checked), F.lit(0))


def parsed_strictly(document: str, schema: str) -> Column:
    """The same, where also a field of another kind stops the query."""
    return F.from_json(document, schema, STRICT)
