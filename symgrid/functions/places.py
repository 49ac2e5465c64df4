"""Where the labels of stored records are, found by the tasks that read them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence


def label_places(keys: Sequence[str], block: int) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow`` over ``part``, ``pos`` and the keys: first and last place of each label in a part, and its rows.

    About ``block`` records are grouped at once, so a label has a row for each block of a part that holds it. Columns:
    ``dim_index`` (1-based), ``value``, ``part``, ``first``, ``last``, ``rows``.
    """

    def places(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def found(records: list) -> Iterator:
            table = pa.Table.from_batches(records)
            for dim_index, key in enumerate(keys, start=1):
                labels = table.group_by(["part", key], use_threads=False).aggregate([("pos", "min"), ("pos", "max"), ("pos", "count")])
                columns = [labels[name] for name in (key, "part", "pos_min", "pos_max", "pos_count")]
                index = pa.chunked_array([pa.repeat(pa.scalar(dim_index, pa.int32()), len(labels))])
                yield from pa.table([index, *columns], ["dim_index", "value", "part", "first", "last", "rows"]).to_batches(max_chunksize=20_000)

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= block:
                yield from found(held)
                held, rows = [], 0
        if rows:
            yield from found(held)

    return places
