"""Lists inside one row, as SQL text: filtering, ordering, de-duplication and JSON.

A document's lists never leave their row, so none of this shuffles. In every fragment
``x`` is the element and ``i`` its position.
"""

from __future__ import annotations

EMPTY_LIST = "[]"


def sort_by(items: str, *keys: str) -> str:
    """Order by keys over ``x``, NULL keys last, original position as tie-break."""
    parts = ", ".join(f"isnull({key}), {key}" for key in keys)
    placed = f"transform({items}, (x, i) -> struct({parts}, i as place, x as item))"
    return f"transform(sort_array({placed}), e -> e.item)"


def by_lower(names: str) -> str:
    """Names ordered without regard to case, exact text as tie-break."""
    return sort_by(names, "lower(x)", "x")


def first_of_each(column: str, key: str) -> str:
    """Elements of a list column whose field ``key``, not NULL, did not occur before.

    Equal keys come to lie side by side by sorting, the first element in front.
    """
    placed = f"transform({column}, (x, i) -> struct(x.{key} as key, i as place, x as item))"
    ordered = f"sort_array(filter({placed}, e -> e.key is not null))"
    # The one-element array names the sorted list, so that it is sorted once.
    firsts = (
        f"transform(array({ordered}), "
        "s -> filter(s, (e, j) -> j = 0 or not (e.key <=> s[j - 1].key)))[0]"
    )
    return (
        f"transform(sort_array(transform({firsts}, e -> struct(e.place, e.item))), e -> e.item)"
    )


def filled(items: str, field: str = "x") -> str:
    """Elements whose text ``field`` has something besides spaces."""
    return f"filter({items}, x -> trim({field}) <> '')"


def joined(names: str, separator: str) -> str:
    """Non-NULL names in list order; NULL when there is none."""
    some = f"exists({names}, x -> x is not null)"
    return f"if({some}, array_join({names}, '{separator}'), null)"


def join_sorted(names: str, separator: str) -> str:
    """Distinct non-NULL names in order; NULL when there is none."""
    present = f"sort_array(array_distinct(filter({names}, x -> x is not null)))"
    return f"if(size({present}) > 0, array_join({present}, '{separator}'), null)"


def json_text(items: str) -> str:
    """JSON text of a list, NULL members written out; NULL for an empty or absent list."""
    return f"if(size({items}) > 0, to_json({items}, map('ignoreNullFields', 'false')), null)"


def relations_to(blocks: str, target: str) -> str:
    """All relations of the blocks with the given target type, in document order."""
    wanted = f"filter({blocks}, b -> b.`target-type` = '{target}')"
    return f"flatten(filter(transform({wanted}, b -> b.relation), r -> r is not null))"
