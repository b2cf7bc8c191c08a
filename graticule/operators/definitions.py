"""Declarative definitions: name -> base, parameters, frequency, output variable."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Definition:
    name: str
    base: str
    freq: str = "YS"
    var_name: str = ""
    params: dict[str, Any] = field(default_factory=dict, hash=False)

    @property
    def output(self) -> str:
        return self.var_name or self.name


def define(name: str, base: str, freq: str = "YS", var_name: str = "", **params: Any) -> Definition:
    return Definition(name, base, freq, var_name or name, params)


def load_definitions(path: str) -> list[Definition]:
    """Definitions from a YAML or JSON file laid out as ``indicators: {name: {base, cf_attrs, parameters, input}}``."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        doc = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as err:
            raise RuntimeError("reading YAML definitions needs the yaml package; use JSON instead") from err
        doc = yaml.safe_load(text)
    out = []
    for name, body in doc["indicators"].items():
        params = {**(body.get("parameters") or {}), **(body.get("input") or {}), **(body.get("properties") or {})}
        freq = params.pop("freq", "YS")
        attrs = body.get("cf_attrs") or {}
        out.append(define(name, body["base"].rsplit(".", 1)[-1], freq, attrs.get("var_name", name), **params))
    return out


def standard_indicators() -> list[Definition]:
    """The 30 indices.  Names, frequencies and thresholds are fixed values."""
    out = []
    for base in ("tg_mean", "tx_mean", "tn_mean", "prcptot", "liquidprcptot", "solidprcptot", "dlyfrzthw"):
        out.append(define(f"{base}_annual", base, "YS", base))
        out.append(define(f"{base}_seasonal", base, "QS-DEC", base))
    out.append(define("growing_degree_days_gt_4_annual", "growing_degree_days", "YS", "growing_degree_days_gt_4",
                      thresh="4 degC"))
    for label, freq in (("annual", "YS"), ("biannual", "2QS-OCT")):
        out.append(define(f"max_n_day_precipitation_amount_n_5_{label}", "max_n_day_precipitation_amount", freq,
                          "rx5day", window=5))
    for base in ("heat_wave_total_length", "heat_wave_frequency"):
        for n, (tn, tx) in enumerate((("20 degC", "33 degC"), ("18 degC", "31 degC"), ("16 degC", "31 degC")), start=1):
            out.append(define(f"{base}_class{n}", base, "YS", thresh_tasmin=tn, thresh_tasmax=tx))
    out.append(define("degree_days_below_0_annual_start_july", "freezing_degree_days", "AS-JUL", "degree_days_below_0",
                      thresh="0 degC"))
    out.append(define("tn_days_above_0_seasonal", "tn_days_above", "QS-DEC", "tn_days_above_0", thresh="0 degC"))
    out.append(define("tn_days_below_m25_seasonal", "tn_days_below", "QS-DEC", "tn_days_below_m25", thresh="-25 degC"))
    for deg in (30, 32):
        out.append(define(f"tx_days_above_{deg}_annual", "tx_days_above", "YS", f"tx_days_above_{deg}",
                          thresh=f"{deg} degC"))
    for deg in (22, 20):
        out.append(define(f"tropical_nights_gt_{deg}_annual", "tn_days_above", "YS", f"tn_days_above_{deg}",
                          thresh=f"{deg} degC"))
    return out


def standard_properties() -> list[Definition]:
    """The 22 diagnostic properties.  Names and parameters are fixed values."""
    out = []
    for v in ("tasmax", "tasmin"):
        out.append(define(f"aca_{v}", "annual_cycle_amplitude", da=v))
    out.append(define("aca_pr", "relative_annual_cycle_amplitude", da="pr"))
    for v in ("tasmax", "tasmin", "pr"):
        out.append(define(f"mean_{v}", "mean", da=v, group="time.month"))
    for q, v in ((0.99, "tasmax"), (0.99, "tasmin"), (0.01, "tasmax"), (0.01, "tasmin"), (0.99, "pr"), (0.95, "pr")):
        out.append(define(f"q{round(q * 100):02d}_{v}", "quantile", da=v, q=q))
    out.append(define("dry_spell_freq", "relative_frequency", da="pr", op="<", thresh="1 mm d-1"))
    out.append(define("lag1_tasmax", "acf", da="tasmax", lag=1, group="time.month"))
    for v in ("tasmin", "pr"):
        out.append(define(f"corr_tasmax_{v}", "corr_btw_var", da1="tasmax", da2=v))
    for v in ("tasmax", "tasmin"):
        out.append(define(f"first_eof_{v}", "first_eof", da=v))
    out.append(define("first_eof_pr", "first_eof", da="pr", kind="*", thresh="0.1 mm/d"))
    for v in ("tasmax", "tasmin", "pr"):
        out.append(define(f"correlogram_{v}", "spatial_correlogram", da=v, bins=99))
    return out


def named(definitions: Iterable[Definition], *names: str) -> list[Definition]:
    by_name = {d.name: d for d in definitions}
    return [by_name[n] for n in names]
