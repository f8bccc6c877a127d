"""Statistics, lists, search, lookup, export and display."""

import json

import pytest

from tessera.operators import serve
from tessera.operators.identity import identity_resolution
from tessera.operators.sampling import customer_sample
from tessera.plans.profile import customers_top, profile_flat, profile_nested
from tessera.schemas import LOOKUP_COLUMNS, SUMMARY_COLUMNS
from tessera.sources.sinks import for_lookup


@pytest.fixture
def people(channels):
    def person(email, first="Ana", last="Roy", **more):
        return {"email": email, "first_name": first, "last_name": last, **more}

    return channels(
        mobile_app=[
            person("ana.roy@x.org"),
            person("Bo%b_O'Neil@x.org", "Bob", "O'Neil"),
            person("NIL@x.org", "Nil", None),
            person("case@x.org", customer_id="CUST0007"),
        ],
        web_portal=[person("ana.roy@x.org"), person("CASE@x.org", customer_id="CUST0008")],
        cobranded_card=[person("zoe\\k@x.org", "Zoë", "K")],
    )


@pytest.fixture
def flat(people):
    return profile_flat(people)


def emails(df):
    return [r["email"] for r in df.collect()]


def test_top_list(flat):
    top = serve.customers_top(flat)
    assert top.columns == list(SUMMARY_COLUMNS)
    assert emails(top)[0] == "ana.roy@x.org"
    rest = emails(top)[1:]
    assert rest == sorted(rest)
    assert emails(serve.customers_top(flat, 2)) == emails(top)[:2]


@pytest.mark.parametrize("limit", [0, 501, -1, True, "5", 2.0])
def test_limits_are_checked(flat, limit):
    with pytest.raises(ValueError):
        serve.list_customers(flat, limit=limit)
    with pytest.raises(ValueError):
        serve.list_customers(flat, "a", limit=limit)


def test_search_is_literal(flat):
    def found(q, **how):
        return emails(serve.list_customers(flat, q, **how))

    assert "ana.roy@x.org" in found("ANA R")
    assert found("o%B") == ["Bo%b_O'Neil@x.org"]
    assert found("%") == ["Bo%b_O'Neil@x.org"]
    assert found("_") == ["Bo%b_O'Neil@x.org"]
    assert found("o'ne") == ["Bo%b_O'Neil@x.org"]
    assert found("\\") == ["zoe\\k@x.org"]
    assert found("ZOË k") == ["zoe\\k@x.org"]
    assert found("nil") == ["NIL@x.org"]  # its name is null, its e-mail matches
    assert found("nobody") == []


def test_search_with_wildcards(flat):
    def found(q):
        return emails(serve.list_customers(flat, q, wildcard=True))

    assert len(found("%")) == 6
    assert found("a_a%y@") == ["ana.roy@x.org"]
    assert found("b_b o") == ["Bo%b_O'Neil@x.org"]


def test_blank_search_is_the_top_list(flat):
    for q in (None, "", "   "):
        assert emails(serve.list_customers(flat, q)) == emails(serve.customers_top(flat))
    assert emails(serve.list_customers(flat, "  nobody ")) == []


def test_lookup(people, flat):
    assert emails(serve.profile_lookup(flat, "ANA.roy@X.org")) == ["ana.roy@x.org"]
    assert emails(serve.profile_lookup(flat, "cAse@x.org")) == ["CASE@x.org"]
    assert emails(serve.profile_lookup(flat, "no@x.org")) == []
    assert emails(serve.profile_lookup(flat, "' or 1=1 --")) == []
    found = serve.profile_lookup(profile_nested(people), "case@x.org")
    assert found.columns == list(LOOKUP_COLUMNS)
    assert emails(found) == ["CASE@x.org"]
    stored = for_lookup(flat)
    assert emails(serve.profile_lookup(stored, "ANA.roy@X.org")) == ["ana.roy@x.org"]


def test_long_history_is_one_row_and_one_text(table):
    rows = [{"email": "a@x.org", "order_id": str(i)} for i in range(9)]
    nested = profile_nested({"mobile_app": table("mobile_app", *rows)})
    assert len(serve.profile_lookup(nested, "A@X.ORG").first()["mobile_app_events"]) == 9
    (text,) = serve.profile_json(nested).collect()
    parsed = json.loads(text["json"])
    assert list(parsed) == list(LOOKUP_COLUMNS) and parsed["web_application_events"] == []
    assert [e["order_id"] for e in parsed["mobile_app_events"]] == [str(i) for i in range(9)]


def test_display_has_the_last_update_of_a_stored_profile(people, flat):
    shown = serve.profile_display(profile_nested(people, as_of="2026-05-01")).first()
    assert shown["last_updated"] is not None
    assert "last_updated" not in serve.profile_display(flat).columns


def test_lookup_many_and_missing(spark, flat):
    asked = ["CASE@X.ORG", "case@x.org", "ana.roy@x.org", "No@x.org", "No@x.org", None]
    wanted = spark.createDataFrame([(e,) for e in asked], "email string")
    found = sorted(emails(serve.lookup_many(flat, wanted)))
    assert found == ["CASE@x.org", "ana.roy@x.org", "case@x.org"]
    assert emails(serve.profiles_missing(flat, wanted)) == ["No@x.org"]


def test_stats(flat, channels):
    row = serve.portfolio_stats(flat).first()
    assert row["total_customers"] == 6 and row["multi_channel_customers"] == 1
    assert row["total_mobile_orders"] == 4 and row["total_mobile_spend"] == 400.0
    assert isinstance(row["total_card_balance"], float)
    empty = serve.portfolio_stats(profile_flat(channels())).first()
    assert empty["total_customers"] == 0
    assert all(v is None for k, v in empty.asDict().items() if k != "total_customers")
    tiles = serve.portfolio_tiles(serve.portfolio_stats(profile_flat(channels()))).collect()
    assert [t["value"] for t in tiles] == ["0"] + ["—"] * 9


def test_report_and_filters(flat):
    assert tuple(serve.load_report(flat).first()) == (6, 1)
    assert emails(serve.multi_channel_customers(flat)) == ["ana.roy@x.org"]
    labels = serve.channel_labels(flat).filter("email = 'ana.roy@x.org'").collect()
    assert [r["label"] for r in labels] == ["Mobile App", "Web Portal"]


def test_json(people):
    stamp = "2026-05-01 12:30:00.5"
    nested = profile_nested(people, as_of=stamp)
    texts = {r["email"]: json.loads(r["json"]) for r in serve.profile_json(nested).collect()}
    ana = texts["ana.roy@x.org"]
    assert list(ana) == list(LOOKUP_COLUMNS)
    assert ana["profile_last_updated"] == "2026-05-01T12:30:00.500000+00:00"
    assert ana["mobile_app_total_spend"] == 100.0 and ana["partner_loan_events"] == []
    assert ana["mobile_app_events"][0]["order_amount"] == 100.0
    assert ana["web_application_events"][0]["applied_date"] == "2025-09-09"
    assert texts["NIL@x.org"]["last_name"] is None  # nulls are kept


def test_display(flat):
    row = serve.profile_display(flat).filter("email = 'ana.roy@x.org'").first()
    assert row["display_name"] == "Ana Roy" and row["channels"] == "Mobile App, Web Portal"
    assert row["mobile_spend"] == "$100" and row["cards"] == "0"
    titles = serve.section_titles(flat).filter("email = 'ana.roy@x.org'").collect()
    assert [(t["section"], t["events"]) for t in titles] == [
        ("mobile_app_events", "1 events"),
        ("web_application_events", "1 events"),
    ]


def test_sample(people):
    customers = identity_resolution(people)
    seeds = {"mobile_app": 1, "web_portal": 2}
    drawn = customer_sample(customers, 3, seeds).collect()
    assert len(drawn) == 6
    for channel in seeds:
        mine = [r for r in drawn if r["channel"] == channel]
        assert len({r["email"] for r in mine}) == 3
        assert sorted(r["position"] for r in mine) == [1, 2, 3]
    again = customer_sample(customers.repartition(6), 3, seeds).collect()
    assert sorted(drawn) == sorted(again)
    assert customer_sample(customers, 50, seeds).count() == 12


def test_top_from_channels_is_that_of_the_profile(channels):
    who = [{"email": f"{c}@x.org", "customer_id": f"C{i}{c}", "first_name": c.upper()}
           for c in "abcde" for i in range(3)] + [{"email": None, "first_name": "Guest"}]
    given = channels(mobile_app=who * 2, partner_checkout=who[4:], web_portal=who[9:13],
                     cobranded_card=[{"email": None}])
    flat = profile_flat(given)
    for limit in (1, 3, 50):
        assert customers_top(given, limit).collect() == serve.customers_top(flat, limit).collect()
    assert customers_top(channels()).collect() == []
    with pytest.raises(ValueError):
        customers_top(given, 0)
