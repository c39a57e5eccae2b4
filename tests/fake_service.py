"""An in-process transport answering for one small layer; no port is opened."""

import json
import re

STATE = {"rows": 57, "cap": 10, "paging": True, "serves": 10, "log": []}
FIELDS = [{"name": "OID", "type": "esriFieldTypeOID"}, {"name": "NAME", "type": "esriFieldTypeString"}, {"name": "AT", "type": "esriFieldTypeDate"}]


def _matching(where, rows):
    ids = range(100, 100 + rows)
    for low, high in re.findall(r"OID >= (\d+) AND OID < (\d+)", where):
        ids = [i for i in ids if int(low) <= i < int(high)]
    for listed in re.findall(r"OID In \(([^)]*)\)", where):
        wanted = {int(x) for x in listed.split(",")}
        ids = [i for i in ids if i in wanted]
    return list(ids)


def fetch(url, form, options):
    """Options named as a state go before it: tasks see only those."""
    state = {**STATE, **{k: int(options[k]) for k in ("rows", "cap", "serves") if k in options}}
    STATE["log"].append((url, dict(form)))
    if "/broken/" in url:
        raise OSError("no route")
    if not url.endswith("/query"):
        return json.dumps({
            "type": "Feature Layer", "maxRecordCount": state["cap"], "fields": FIELDS,
            "advancedQueryCapabilities": {"supportsPagination": state["paging"]},
        })
    ids = _matching(form["where"], state["rows"])
    if form.get("returnCountOnly") == "true":
        return json.dumps({"count": len(ids)})
    if form.get("returnIdsOnly") == "true":
        return json.dumps({"objectIdFieldName": "OID", "objectIds": ids or None})
    if "outStatistics" in form:
        return json.dumps({"features": [{"attributes": {"MIN_ID": min(ids), "MAX_ID": max(ids)}}]})
    offset = int(form.get("resultOffset", 0))
    ids = ids[offset : offset + int(form.get("resultRecordCount", len(ids)))]
    served = ids[: state["serves"]]
    return json.dumps({
        "features": [{"attributes": {"OID": i, "NAME": f"n{i}", "AT": i * 1000}, "geometry": {"x": i, "y": 0}} for i in served],
        "exceededTransferLimit": len(served) < len(ids),
    })
