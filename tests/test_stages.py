import random

import pytest

from dossier.plans.documents import build_customer_model, build_customer_stats
from dossier.plans.scoring import WATCH_LIST, count_linked, count_linked_flat, score_link
from dossier.plans.stages import run_stages
from dossier.sources.files import (
    read_accounts,
    read_addresses,
    read_customer_accounts,
    read_customer_documents,
    read_customer_model,
    read_customers,
    write_stage,
)
from tests.util import plain


def write_inputs(folder):
    (folder / "c.csv").write_text(
        "customerId,forename,surname\nC1,Ann,Lee\nC2,Bob,Ray\nC2,Bob,Ray\nC3,Cy,Poe\n")
    (folder / "a.csv").write_text(
        "customerId,accountId,balance\nC1,A1,10\nC1,A2,5\nC9,A3,7\nC2,A4,1\n")
    (folder / "d.csv").write_text(
        "addressId,customerId,address\n"
        'D1,C1,"1, Road, City, Denmark"\nD2,C2,"2, Road, City, British Virgin Islands"\n'
        'D3,C2,"3, Road, City, Ireland"\nD4,C9,"not, an, address"\n')
    return [str(folder / name) for name in ("c.csv", "a.csv", "d.csv")]


@pytest.mark.parametrize("limits", [{}, {"max_repeats": 1}], ids=str)
def test_run_from_csv(spark, tmp_path, limits):
    out = str(tmp_path / "out")
    scored = run_stages(spark, *write_inputs(tmp_path), out, **limits)
    assert count_linked(scored).first()[0] == 2
    stats = read_customer_accounts(spark, f"{out}/customer_accounts")
    assert sorted((r.customerId, r.numberAccounts, r.totalBalance, r.averageBalance) for r in stats.collect()) == [
        ("C1", 2, 15, 7.5), ("C2", 1, 1, 1.0), ("C2", 1, 1, 1.0), ("C3", 0, 0, 0.0)]
    again = score_link(read_customer_documents(spark, f"{out}/customer_documents"), ["Denmark"], "danish")
    assert {r.customerId for r in again.where("danish").collect()} == {"C1"}


COUNTRIES = ["United Kingdom", "Australia", "British Virgin Islands", "Ireland"]


def made_files(folder):
    """500 customers with none to six accounts and one address each, 55 accounts of unknown customers."""
    rnd = random.Random(2024)
    ids = [f"IND{i:04}" for i in range(1, 501)]
    owners = [key for key in ids for _ in range(rnd.choice([0, 0, 1, 1, 1, 2, 2, 3, 4, 5, 6]))]
    owners += [f"IND{rnd.randrange(501, 551):04}" for _ in range(55)]
    rnd.shuffle(owners)
    acc = [(key, f"ACC{i:04}", rnd.randrange(4, 1000)) for i, key in enumerate(owners, 1)]
    adr = [(f"ADR{i:03}", key, rnd.randrange(5, 1000), f"Road {rnd.randrange(50)}", f"City {rnd.randrange(11)}",
            rnd.choices(COUNTRIES, [6, 4, 1, 1])[0]) for i, key in enumerate(rnd.sample(ids, 500), 1)]
    names = {key: (f"F{rnd.randrange(150)}", f"S{rnd.randrange(140)}") for key in ids}
    (folder / "c.csv").write_text("customerId,forename,surname\n" + "".join(f"{k},{f},{s}\n" for k, (f, s) in names.items()))
    (folder / "a.csv").write_text("customerId,accountId,balance\n" + "\n".join(f"{k},{a},{b}" for k, a, b in acc))
    (folder / "d.csv").write_text("addressId,customerId,address\n" + "".join(
        f'{d},{k},"{n}, {r}, {c}, {land}"\n' for d, k, n, r, c, land in adr))
    return names, acc, adr, [str(folder / name) for name in ("c.csv", "a.csv", "d.csv")]


@pytest.mark.parametrize("limits", [{}, {"max_repeats": 1}], ids=str)
def test_made_files_end_to_end(spark, tmp_path, limits):
    """Every value of every stage, expected by plain Python."""
    names, acc, adr, files = made_files(tmp_path)
    scored = run_stages(spark, *files, str(tmp_path / "out"), **limits)
    owned = {key: sorted((k, a, b) for k, a, b in acc if k == key) for key in names}
    lived = {key: [(d, k, f"{n}, {r}, {c}, {land}", n, r, c, land) for d, k, n, r, c, land in adr if k == key] for key in names}
    expected = {
        key: (key, *name, tuple(owned[key]), tuple(lived[key]), any(x[-1] == WATCH_LIST[0] for x in lived[key]))
        for key, name in names.items()
    }
    assert {r.customerId: plain(r) for r in scored.collect()} == expected
    linked = sum(row[-1] for row in expected.values())
    assert 0 < linked < 500 and count_linked(scored).first()[0] == linked
    assert count_linked_flat(read_customers(spark, files[0]), read_addresses(spark, files[2])).first()[0] == linked
    stats = {key: (len(x), sum(b for *_, b in x), sum(b for *_, b in x) / len(x) if x else 0.0) for key, x in owned.items()}
    stored = read_customer_accounts(spark, f"{tmp_path}/out/customer_accounts").drop("accounts")
    flat = build_customer_stats(read_customers(spark, files[0]), read_accounts(spark, files[1]))
    for df in (stored, flat):
        assert {r.customerId: tuple(r)[3:] for r in df.collect()} == stats
    assert sum(x[0] for x in stats.values()) == len(acc) - 55 and any(not x[0] for x in stats.values())


def test_made_model_round_trip(spark, tmp_path):
    names, _, _, files = made_files(tmp_path)
    path = f"{tmp_path}/model"
    write_stage(build_customer_model(read_customers(spark, files[0])), path)
    model = read_customer_model(spark, path)
    assert {r.customerId: (r.forename, r.surname, plain(r.fullname)) for r in model.collect()} == {
        key: (*name, name) for key, name in names.items()}
