"""Small builders for literal raw pages."""

import datetime as dt
import json

RAW_SCHEMA = "raw_payload STRING, ingested_at TIMESTAMP, source_uri STRING, ingest_date DATE"
ROOT = "lake://zone"


def uri(country, part, leaf):
    return f"{ROOT}/raw/airq/{country}/{part}/{leaf}.json"


def reading(value, start, parameter="pm25", units="µg/m³", hours=1):
    s = dt.datetime.fromisoformat(start)
    e = s + dt.timedelta(hours=hours)
    return {
        "value": value,
        "parameter": {"name": parameter, "units": units},
        "period": {
            "label": "raw",
            "interval": "01:00:00",
            "datetimeFrom": {"utc": s.strftime("%Y-%m-%dT%H:%M:%SZ")},
            "datetimeTo": {"utc": e.strftime("%Y-%m-%dT%H:%M:%SZ")},
        },
        "coverage": {"observedCount": 1, "percentCoverage": 100.0},
    }


def page(*records):
    return json.dumps({"results": list(records)})


def location(loc_id, country, sensors, is_monitor=True, first=None, last=None):
    return {
        "id": loc_id,
        "name": f"station {loc_id}",
        "locality": "somewhere",
        "country": {"code": country},
        "isMonitor": is_monitor,
        "provider": {"name": "provider"},
        "coordinates": {"latitude": 1.0, "longitude": 2.0},
        "timezone": "UTC",
        "datetimeFirst": {"utc": first} if first else None,
        "datetimeLast": {"utc": last} if last else None,
        "sensors": [{"id": sid, "parameter": {"name": p, "units": "µg/m³"}} for sid, p in sensors],
    }


def raw_row(body, stamp, source_uri):
    ts = dt.datetime.fromisoformat(stamp)
    return (body, ts, source_uri, ts.date())


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)
