"""Plans that the driver writes out again and again stay small."""

from keelstone.llm import fingerprint


def test_plans_of_fingerprints_hold_no_unicode_tables(docs, monkeypatch):
    plans = {}
    staged = fingerprint.staged

    def measured(df, name):
        plans[f"{name} {len(plans)}"] = len(df._jdf.queryExecution().toString())
        return staged(df, name)

    monkeypatch.setattr(fingerprint, "staged", measured)
    out = fingerprint.fingerprints(docs(["plain", "ﬁne", "fine", "ａ̣́", None]))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["fingerprint"] == rows[2]["fingerprint"] and rows[1]["near_next"] == 1.0
    tables = [k for k in plans if k.startswith("unicode")]
    assert len(tables) == 1  # the tables are written once, by a plan of their own
    assert max(n for k, n in plans.items() if k not in tables) < 200_000, plans
