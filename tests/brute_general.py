"""Plain, record-at-a-time versions of the general operators, as the check of the Spark ones."""

import json
import re
from decimal import ROUND_HALF_UP, Decimal

LV = r"(debug|dbg|info|inf|warn|warning|wrn|error|err|critical|crit|fatal)"
NAME = {"deb": "DEBUG", "dbg": "DEBUG", "inf": "INFO", "war": "WARNING", "wrn": "WARNING", "err": "ERROR", "cri": "CRITICAL", "fat": "CRITICAL"}
HEADS = [
    (r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z \[" + LV + r"\] ([\w.\-]+): ", 1, 2),
    (r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d{3} - ([\w.\-]+) - " + LV + " - ", 2, 1),
    (r"\[\d{10}\.\d{3}\] <" + LV + r"> ([\w.\-]+) :: ", 1, 2),
    (r"\[\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\] ([\w.\-]+)\." + LV + ": ", 2, 1),
    (r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3} \| " + LV + r" *\| ([\w.\-]+):\w+:\d+ - ", 1, 2),
    (r"([A-Z][a-z]{2} [ \d]\d) \d\d:\d\d:\d\d [\w\-]+ ([\w.\-]+)\[\d+\]: " + LV + ": ", 3, 2),
    (r"\d{4}/\d\d/\d\d \d\d:\d\d:\d\d \[" + LV + r"\] \d+#\d+: ", 1, None),
    (r"\d\d:\d\d:\d\d\.\d{3} \[[\w\-]+\] " + LV + r" +([\w.\-]+) - ", 1, 2),
    (LV + r" \d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}\+00:00 \(([\w.\-]+)\) ", 1, 2),
]
HEADS = [(re.compile(p, re.I), a, b) for p, a, b in HEADS]


def head(line: str):
    line = re.sub(r"\x1b\[\d+m", "", line).rstrip("\r")
    if m := re.match(r"([DIWEFC])\d{4} \d\d:\d\d:\d\d\.\d{6} +\d+ ([\w.\-]+):\d+\] ", line):
        return {"D": "DEBUG", "I": "INFO", "W": "WARNING", "E": "ERROR", "F": "CRITICAL", "C": "CRITICAL"}[m[1]], m[2]
    if line.startswith("{"):
        try:
            v = json.loads(line)
        except ValueError:
            return None
        lv = v.get("lvl") or v.get("level") or v.get("severity")
        has = any(k in v for k in ("ts", "time", "@timestamp", "timestamp"))
        return (NAME[lv[:3].lower()], v.get("logger") or v.get("component") or v.get("name") or "") if lv and has else None
    if re.match(r"(time|level)=", line):
        t, lv, c = (re.search(rf"(?:^| ){k}=(\S+)", line.split(" msg=")[0]) for k in ("time", "level", "component"))
        return (NAME[lv[1][:3].lower()], c[1] if c else "") if t and lv else None
    for p, a, b in HEADS:
        if m := p.match(line):
            return NAME[m[a][:3].lower()], m[b] if b else ""
    return None


def entries(text: str):
    out, live = [], False
    for n, line in enumerate(text.split("\n"), 1):
        if h := head(line):
            out.append([n, n, *h])
            live = True
        elif not line.strip():
            live = False
        elif live:
            out[-1][1] = n
    return {tuple(x) for x in out}


def builds(doc: str):
    v = json.loads(doc)
    rs = v if isinstance(v, list) else v.get("results", (v.get("report") or {}).get("results"))
    out = set()
    for i, r in enumerate(rs or []):
        if r is None:
            continue
        st = r.get("stages") or {}
        checks = [(0, st.get("functional"))] + [(int(k[6:]), (x or {}).get("functional")) for k, x in st.items() if re.fullmatch(r"retry_\d+", k)]
        checks += [(a.get("attempt"), a) for a in r.get("validation_attempts") or []]
        for no, c in checks:
            d = (c or {}).get("details")
            d = json.loads(d) if isinstance(d, str) else d
            if not d or d.get("build") is None:
                continue
            s = d["build"].get("success")
            s = "unknown" if s is None else "true" if str(s).lower() in ("true", "1") else "false"
            t = c.get("execution_times")
            t = {x["phase"]: x["seconds"] for x in t} if isinstance(t, list) else t or {}
            t = t.get("build")
            if t is None:
                ms = -1
            else:
                num, unit = re.fullmatch(r"([\d.]+) ?(ms|s)?", str(t)).groups()
                ms = int((Decimal(num) * (1 if unit == "ms" else 1000)).quantize(Decimal(1), ROUND_HALF_UP))
            out.add((i, no, s, ms))
    return out


ALIAS = {"isResolved": "is_resolved", "resolved": "is_resolved", "solved": "is_resolved", "agentStartedAt": "agent_started_at", "agent_start": "agent_started_at", "cast_file": "recording_path", "completion_tokens": "total_output_tokens",
         "input_tokens": "total_input_tokens", "prompt_tokens": "total_input_tokens", "totalInputTokens": "total_input_tokens", "parserResults": "parser_results", "test_results": "parser_results", "unit_tests": "parser_results"}


def changes(rows):
    """rows: (stream, file, record_json) -> {(stream, file, field, kind)}"""
    files = {}
    for s, n, j in rows:
        f = files.setdefault(s, {}).setdefault(n, {})
        try:
            v = json.loads(j)
        except (ValueError, TypeError):
            continue
        if not isinstance(v, dict):
            continue
        for k, x in v.items():
            t = {bool: "b", int: "n", float: "n", str: "s", dict: "o", list: "a", type(None): None}[type(x)]
            f.setdefault(ALIAS.get(k, k), (set(), set()))
            f[ALIAS.get(k, k)][0].add(k)
            if t:
                f[ALIAS.get(k, k)][1].add(t)
    out = set()
    for s, by in files.items():
        for p, n in zip(sorted(by), sorted(by)[1:]):
            a, b = by[p], by[n]
            out |= {(s, n, k, "added") for k in b.keys() - a.keys()} | {(s, n, k, "removed") for k in a.keys() - b.keys()}
            for k in a.keys() & b.keys():
                if not a[k][0] & b[k][0]:
                    out.add((s, n, k, "renamed"))
                if a[k][1] and b[k][1] and a[k][1] != b[k][1]:
                    out.add((s, n, k, "retyped"))
    return out
