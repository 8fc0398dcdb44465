"""Hand-made order documents with longer arrays than the star documents have."""

import json


def rate(kind, quantity=1, sub="10.00", price="10.00", tax="0.80", **more):
    return {
        "rateType": kind,
        "quantity": quantity,
        "subTotal": float(sub),
        "price": float(price),
        "taxTotal": float(tax),
        **more,
    }


def visit(day, schedule=1, event=None, end="12:00:00", name="Slot"):
    return {
        "id": event,
        "type": "Admission",
        "name": name,
        "schedule": {
            "id": schedule,
            "date": day,
            "startTime": f"{day}T10:00:00Z",
            "endTime": f"{day}T{end}Z",
        },
    }


def line(id, type="Rate", rates=(), event=None, **more):
    return {"id": id, "type": type, "rateTypes": list(rates), "event": event, **more}


def order(id, created="2026-03-01T18:00:00Z", modified=None, status="Active", lines=(), **more):
    return {
        "id": id,
        "createdDate": created,
        "modifiedDate": modified or created,
        "status": status,
        "currencyName": "USD",
        "total": 10.8,
        "subTotal": 10.0,
        "taxTotal": 0.8,
        "discountTotal": 0.0,
        "gratuityTotal": 0.0,
        "salesOfficeName": "Front Desk",
        "isWebOrder": False,
        "lineItems": list(lines),
        **more,
    }


def write(folder, docs, name="page.json"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in docs))
    return str(folder)


def documents(spark, folder, docs):
    from turnstile.sources.landing import raw_scan

    return raw_scan(spark, write(folder, docs))
