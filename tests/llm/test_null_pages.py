"""Pages of one id, null among them, spread over the tasks that write archives."""

from __future__ import annotations

import collections

import pytest

from spendmill.llm.warc import captures, read_records, write_archives


@pytest.mark.parametrize("ident", [None, 5])
def test_pages_of_one_id_spread_over_files(spark, tmp_path, ident):
    pages = [(ident, None, f"page {i % 200}") for i in range(600)] + [(9, None, "page 0"), (9, None, "alone")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    write_archives(frame, str(tmp_path / "w"), compression="none", records_per_file=1_000_000)
    records = read_records(spark, str(tmp_path / "w")).cache()
    assert len([x for x in (tmp_path / "w").glob("part-*") if x.stat().st_size > 10_000]) > 1
    assert records.select("record_id").distinct().count() == records.count() == 3 * len(pages)
    found = captures(records).collect()
    kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in found)
    # The smallest id is the original; a null id comes last.
    want = {(ident, "response", None): 199 if ident is None else 200, (ident, "revisit", ident): 398 if ident is None else 400}
    if ident is None:
        want |= {(None, "revisit", 9): 3, (9, "response", None): 2}
    else:
        want |= {(9, "revisit", 5): 1, (9, "response", None): 1}
    assert kinds == want
