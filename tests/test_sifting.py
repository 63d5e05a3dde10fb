import pytest

from dossier.plans.documents import build_customer_accounts, build_documents
from dossier.plans.sifting import (
    ADDRESS,
    BALANCE,
    ROW,
    bad_balance,
    sift,
    sift_accounts,
    sift_addresses,
    sift_customers,
    sifted,
)
from tests.test_nesting import jobs_of
from tests.util import accounts, customers, plain


def rejects(parts):
    return sorted((r.reason, r.source.rsplit("/", 1)[-1], r.record) for r in parts.rejected.collect())


def test_accounts(spark, tmp_path):
    folder = tmp_path / "acc"
    folder.mkdir()
    (folder / "1.csv").write_text("customerId,accountId,balance\nC1,A1,10\nC1,A2\nC2,A3,4,5\nC2,A4,n/a\n")
    (folder / "2.csv").write_text('customerId,accountId,balance\nC3,A5,-7\nC3,"A,6",\nC3,A7,1.5\n')
    parts = sift_accounts(spark, str(folder), str(tmp_path / "out"))
    assert sorted(plain(r) for r in parts.sound.collect()) == [("C1", "A1", "10"), ("C3", "A5", "-7")]
    assert rejects(parts) == [
        (BALANCE, "1.csv", "C2,A4,n/a"), (BALANCE, "2.csv", 'C3,"A,6",'), (BALANCE, "2.csv", "C3,A7,1.5"),
        (ROW, "1.csv", "C1,A2"), (ROW, "1.csv", "C2,A3,4,5"),
    ]
    assert parts.counts == {"rows": 7, "sound": 2, ROW: 2, BALANCE: 3}
    again = sifted(spark, str(tmp_path / "out"))
    assert again.counts == parts.counts and rejects(again) == rejects(parts)
    # What is sound passes strict mode.
    built = build_customer_accounts(customers(spark, "C1", "C3"), parts.sound)
    assert sorted((r.customerId, r.totalBalance) for r in built.collect()) == [("C1", 10), ("C3", -7)]


def test_addresses_and_customers(spark, tmp_path):
    (tmp_path / "d.csv").write_text(
        'addressId,extra,customerId,address\nD1,x,C1,"1, a, b, c"\nD2,x,C1,"no number, a, b, c"\nD3,x,C1,\nD4,x,C1,"4, a, b"\nD5\n'
    )
    (tmp_path / "c.csv").write_text("surname,customerId,forename\nLee,C1,Ann\nRay,C2\n")
    adr = sift_addresses(spark, str(tmp_path / "d.csv"), str(tmp_path / "adr"))
    cus = sift_customers(spark, str(tmp_path / "c.csv"), str(tmp_path / "cus"))
    assert adr.counts == {"rows": 5, "sound": 1, ROW: 1, ADDRESS: 3} and cus.counts == {"rows": 2, "sound": 1, ROW: 1}
    assert rejects(cus) == [(ROW, "c.csv", "Ray,C2")]
    assert [r[2] for r in rejects(adr)] == ['D2,C1,"no number, a, b, c"', "D3,C1,", 'D4,C1,"4, a, b"', "D5"]
    built = build_documents(cus.sound, accounts(spark), adr.sound).collect()
    assert [(r.customerId, len(r.address)) for r in built] == [("C1", 1)]


@pytest.mark.parametrize("rows", [[], [("C1", "A1", "5")], [("C1", "A1", "x")], [(None, None, None)]])
def test_all_or_none_sound(spark, tmp_path, rows):
    parts = sift(accounts(spark, *rows), {BALANCE: bad_balance()}, str(tmp_path / "out"))
    sound = [r for r in rows if r[2] == "5"]
    assert [plain(r) for r in parts.sound.collect()] == sound and parts.rejected.count() == len(rows) - len(sound)
    assert parts.counts == {"rows": len(rows), "sound": len(sound), BALANCE: len(rows) - len(sound)}


def test_one_pass_over_the_input(spark, tmp_path):
    accounts(spark, *[("C1", f"A{i}", "1" if i % 3 else "x") for i in range(30)]).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    plain_write = jobs_of(spark, lambda: df.write.parquet(str(tmp_path / "plain")))
    assert jobs_of(spark, lambda: sift(df, {BALANCE: bad_balance()}, str(tmp_path / "out"))) == plain_write


def test_a_header_of_another_order_is_an_error(spark, tmp_path):
    folder = tmp_path / "c"
    folder.mkdir()
    (folder / "1.csv").write_text("customerId,forename,surname\nC1,a,b\n")
    (folder / "2.csv").write_text("surname,forename,customerId\nb,a,C2\n")
    with pytest.raises(Exception, match="(?i)header"):
        sift_customers(spark, str(folder), str(tmp_path / "out"))


def test_nothing_sifted(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing was sifted"):
        sifted(spark, str(tmp_path))
