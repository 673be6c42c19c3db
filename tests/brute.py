"""Row-by-row model of the cascade in exact whole numbers, for small fixtures only."""

from __future__ import annotations

from collections import defaultdict

ONE = 10**12


def shares(raw: dict[str, int]) -> dict[str, int] | None:
    total = sum(raw.values())
    if total == 0:
        return None
    units = {t: r * ONE // total for t, r in raw.items()}
    order = sorted(raw, key=lambda t: (-(raw[t] * ONE % total), -raw[t], t))
    for target in order[: ONE - sum(units.values())]:
        units[target] += 1
    return units


def spread(cents: int, units: dict[str, int]) -> dict[str, int]:
    parts = {t: cents * u // ONE for t, u in units.items()}
    order = sorted(units, key=lambda t: (-(cents * units[t] % ONE), -units[t], t))
    spare = max(cents - sum(parts.values()), 0)
    for place, target in enumerate(order):
        parts[target] += spare // len(order) + (1 if place < spare % len(order) else 0)
    return parts


def outcome(rule: dict, seen: dict[str, dict[str, int]]) -> tuple[dict[str, int] | None, str | None]:
    """Split of one source from its signals per metric, or the reason against it."""
    if not seen:
        return None, "shared_unattributable"
    targets = {t for metric in seen.values() for t in metric}
    strategy = rule["strategy"]
    if strategy == "manual_override":
        return dict(rule["proportions"]), None
    if strategy == "even_spread":
        raw = dict.fromkeys(targets, 1)
    elif strategy == "weighted":
        raw = {t: rule["weights"].get(t, 0) for t in targets | set(rule["weights"])}
    else:
        raw = {t: seen.get(rule["metric_name"], {}).get(t, 0) for t in targets}
    found = shares(raw)
    return (found, None) if found else (None, "driver_zero")


def cascade(lines, usage, towers, rule):
    """lines: (id, cents, tower or None); usage: (step, from, to, metric, cents)."""
    seen = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
    for step, source, target, metric, value in usage:
        seen[step, source][metric][target] += value
    ends = []
    for line, cents, tower in lines:
        if tower is not None:
            flows = [(tower, cents)]
        else:
            fallback = rule["gl_to_tower"]
            if fallback is None:
                ends.append((line, None, None, None, cents, "gl_to_tower", "unmapped"))
                continue
            if fallback["strategy"] == "manual_override":
                units = dict(fallback["proportions"])
            elif fallback["strategy"] == "weighted":
                units = shares({t: fallback["weights"].get(t, 0) for t in towers})
            else:
                units = shares(dict.fromkeys(towers, 1))
            if units is None:
                ends.append((line, None, None, None, cents, "gl_to_tower", "driver_zero"))
                continue
            flows = [(t, part) for t, part in spread(cents, units).items() if part]
        for tower_id, tower_cents in flows:
            units, reason = outcome(rule["tower_to_app"], seen["tower_to_app", tower_id])
            if units is None:
                ends.append((line, tower_id, None, None, tower_cents, "tower_to_app", reason))
                continue
            for app, app_cents in spread(tower_cents, units).items():
                if not app_cents:
                    continue
                inner, reason = outcome(rule["app_to_bu"], seen["app_to_bu", app])
                if inner is None:
                    ends.append((line, tower_id, app, None, app_cents, "app_to_bu", reason))
                    continue
                ends += [
                    (line, tower_id, app, bu, part, None, None) for bu, part in spread(app_cents, inner).items() if part
                ]
    return ends
