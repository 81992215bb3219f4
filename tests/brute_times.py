"""A plain, row-at-a-time reading of printed times, as the check of the Spark operator."""

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

MON = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
ABBR = {"UTC": 0, "GMT": 0, "EST": -5, "EDT": -4, "PST": -8, "PDT": -7, "CET": 1, "CEST": 2, "AEST": 10, "AEDT": 11, "JST": 9}
EPOCH = datetime(1970, 1, 1)


def local_us(dt: datetime, zone: str | None) -> int:
    zone = zone or "UTC"
    tz = ZoneInfo(zone)
    off = dt.replace(tzinfo=tz, fold=0).utcoffset()  # in a gap: the offset before it, which moves the time forward
    return (dt - EPOCH - off) // timedelta(microseconds=1)


def read(v: str | None, host: str | None) -> int | None:
    if v is None or re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00", v):
        return None
    v = v.strip()
    if re.fullmatch(r"\d{10}|\d{13}|\d{16}", v):
        return int(v) * 10 ** (16 - len(v))
    if re.fullmatch(r"\d{10}\.\d{3}", v):
        return int(v.replace(".", "")) * 1000
    z = ""
    if m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)[Tt ](\d\d):(\d\d)(?::(\d\d)(?:[.,](\d+))?)?(.*)", v):
        y, mo, d, h, mi, s, fr, z = m.groups()
    elif m := re.fullmatch(r"(\d{4})(\d\d)(\d\d)[-T](\d\d)(\d\d)(\d\d)(Z?)", v):
        y, mo, d, h, mi, s, z = m.groups()
        fr = None
    elif m := re.fullmatch(r"(\d\d)/(\d\d)/(\d{4}) (\d\d):(\d\d):(\d\d) ([AP]M)", v):
        mo, d, y, h, mi, s, ap = m.groups()
        h, fr = int(h) % 12 + 12 * (ap == "PM"), None
    elif m := re.fullmatch(r"(\d\d)\.(\d\d)\.(\d{4}) (\d\d):(\d\d):(\d\d)", v):
        d, mo, y, h, mi, s = m.groups()
        fr = None
    elif m := re.fullmatch(r"(?:\w{3}, )?(\d{1,2}) (\w{3}) (\d{4}) (\d\d):(\d\d):(\d\d)(.*)", v):
        d, mo, y, h, mi, s, z = m.groups()
        mo, fr = MON[mo.lower()], None
    elif m := re.fullmatch(r"\w{3} (\w{3}) +(\d{1,2}) (\d\d):(\d\d):(\d\d) (\d{4})", v):
        mo, d, h, mi, s, y = m.groups()
        mo, fr = MON[mo.lower()], None
    else:
        return None
    try:
        dt = datetime(int(y), int(mo), int(d), int(h), int(mi), int(s or 0), int((fr or "0")[:6].ljust(6, "0")))
    except ValueError:
        return None
    z = z.strip()
    if not z:
        return local_us(dt, host)
    if z.startswith("["):
        return local_us(dt, z[1:-1])
    if z in ("Z", "z"):
        off = timedelta(0)
    elif m := re.fullmatch(r"([+-])(\d\d):?(\d\d)?", z):
        off = timedelta(hours=int(m[2]), minutes=int(m[3] or 0)) * (-1 if m[1] == "-" else 1)
    else:
        off = timedelta(hours=ABBR[z])
    return (dt.replace(tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc) - off) // timedelta(microseconds=1)
