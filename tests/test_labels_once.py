"""A label is looked for once in a document, whatever is made of what is found."""

import __spark_entry__ as entry


def test_each_look_up_stands_once_in_the_plan(spark):
    for name, label in (("consignment_rows", "GTA Name"), ("consignment_rows", "Consignment Note Date"), ("entitlement_records", "LUT ARN"), ("master_records", "Date of Incorporation")):
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        patterns = plan.count(f"[ \\t]*{label}[ \\t]*:") or plan.count(f"[ \t]*{label}[ \t]*:")
        assert patterns == 1, (name, label, patterns)
