"""Malformed CSV lines are set aside, all of them and no others."""
import pytest

from shelfcast.schemas import PRICES_SCHEMA
from shelfcast.sources import quarantine as qu

HEAD = "store_id,item_id,wm_yr_wk,sell_price"
GOOD = ["CA_1,A,11101,2.5", 'CA_1,"B, large",11102,3', "TX_1,C,NA,", '"x ""y""",D,11103,1e1']
BAD = {"CA_1,A,week,2.5": "no value of its type: wm_yr_wk", "CA_1,A,11101": "3 fields, not 4", "CA_1,A,11101,2.5,6": "5 fields, not 4",
       "CA_1,A,1.5x,cheap": "no value of its type: sell_price wm_yr_wk"}


def folder(tmp_path, *files):
    d = tmp_path / "raw"
    d.mkdir()
    for i, lines in enumerate(files):
        (d / f"f{i}.csv").write_text("\n".join(lines) + "\n")
    return str(d)


def test_good_and_rejects_are_all_lines(spark, tmp_path):
    bad = list(BAD)
    path = folder(tmp_path, [HEAD, *GOOD[:2], bad[0], "", bad[1]], [HEAD, bad[2], *GOOD[2:], bad[3]])
    good, rejects = qu.read_with_rejects(spark, path, null_tokens=["NA"], max_rejects=4)
    assert good.schema == PRICES_SCHEMA
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(
        [("CA_1", "A", 11101, 2.5), ("CA_1", "B, large", 11102, 3.0), ("TX_1", "C", None, None), ('x "y"', "D", 11103, 10.0)], key=repr)
    got = rejects.collect()
    assert {r.line: set(r.reason.split()) for r in got} == {k: set(v.split()) for k, v in BAD.items()} and len(got) == len(BAD)
    assert {r.file.rsplit("/", 1)[1] for r in got if r.line in bad[:2]} == {"f0.csv"}
    with pytest.raises(qu.RejectBudgetError, match="4 lines rejected, 3 allowed"):
        qu.read_with_rejects(spark, path, null_tokens=["NA"], max_rejects=3)


def test_headers_and_empty_files(spark, tmp_path):
    with pytest.raises(ValueError, match="header"):
        qu.read_with_rejects(spark, folder(tmp_path, [HEAD, GOOD[0]], ["other,item_id,wm_yr_wk,sell_price", GOOD[0]]), max_rejects=9)
    (tmp_path / "raw2").mkdir()
    (tmp_path / "raw2" / "f.csv").write_text(HEAD + "\n")
    good, rejects = qu.read_with_rejects(spark, str(tmp_path / "raw2"))
    assert good.count() == rejects.count() == 0


def test_many_day_columns(spark, tmp_path):
    days = [f"d_{i}" for i in range(1, 400)]
    head = "id,item_id,dept_id,cat_id,store_id,state_id," + ",".join(days)
    row = lambda k, **odd: f"i{k},a,b,c,d,e," + ",".join(odd.get(d, str(k)) for d in days)
    good, rejects = qu.read_with_rejects(spark, folder(tmp_path, [head, row(1), row(2, d_7="x", d_300="1.5"), row(3, d_9="")]), max_rejects=1)
    assert sorted((r.id, r.d_1, r.d_9, r.d_399) for r in good.collect()) == [("i1", 1, 1, 1), ("i3", 3, None, 3)]
    assert [r.reason for r in rejects.collect()] == ["no value of its type: d_7 d_300"]
