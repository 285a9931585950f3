"""Reads over a price store: history, reports, checks and exports."""

from ..operators import history, membership, ranges, repair, reports, review
from ..sinks import exports
from .store import PriceStore


def symbol_history(
    store: PriceStore, symbols, start, end, buffer_start=None, index_name=None, split=True, flag_mode="asof"
):
    return history.symbol_history(
        store.read("bars_mod"),
        start,
        end,
        symbols,
        buffer_start,
        index_name,
        store.read("snapshots") if index_name is not None else None,
        store.read("multipliers") if split else None,
        flag_mode,
    )


def index_history(store: PriceStore, index_name, start, end, buffer_start=None, split=True, flag_mode="asof"):
    return history.index_history(
        store.read("bars_mod"),
        store.read("snapshots"),
        index_name,
        start,
        end,
        buffer_start,
        store.read("multipliers") if split else None,
        flag_mode,
    )


def split_history(store: PriceStore, symbols=None):
    return history.split_history(store.read("multipliers"), symbols)


def index_change_history(store: PriceStore, index_name):
    """Snapshot rows of the index, and its change dates."""
    snapshots = store.read("snapshots")
    return membership.change_history(snapshots, index_name), membership.change_dates(snapshots, index_name)


def table_report(store: PriceStore):
    """Totals per year of the raw and the modified bars, and where they differ."""
    raw, mod = store.read("bars"), store.read("bars_mod")
    return reports.year_totals(raw), reports.year_totals(mod, adjusted=True), reports.year_totals_diff(raw, mod)


def check_change_dates(store: PriceStore):
    return membership.check_change_dates(
        store.read("index_changes"), store.read("bars_mod"), store.read("symbol_range")
    )


def membership_flags(store: PriceStore, indices=None, from_year=1995):
    return membership.membership_flags(store.read("bars_mod"), store.read("snapshots"), indices, from_year)


def flags_recon(store: PriceStore, flags, indices=None, end_year=None):
    return membership.flags_recon(flags, store.read("snapshots"), indices, end_year)


def replaceable_pairs(store: PriceStore):
    """The two files for review: kept bars, and the rejected rows that could replace them."""
    scores = repair.score_skipped(store.read("bars").drop("year"), store.read("bars_skipped"))
    return review.pair_rows(repair.replaceable(scores))


def write_reports(store: PriceStore, path, indices=None, from_year=1995) -> dict[str, int]:
    """All reports and the yearly flag files as CSV; returns the rows of each, counted while writing.

    One folder per report, `flags/year=...` for the flags.
    """
    selected, skipped = replaceable_pairs(store)
    raw, modified, differences = table_report(store)
    frames = {
        "unverified": store.read("bars_unverified").drop("seq", "batch"),
        "replaceable_selected": selected,
        "replaceable_skipped": skipped,
        "replacements_refused": store.read("replacements_refused").drop("seq", "batch"),
        "symbol_range": store.read("symbol_range"),
        "range_anomalies": store.read("range_anomalies").drop("batch"),
        "modified_losers": store.read("modified_losers").drop("batch"),
        "multipliers_skipped": store.read("multipliers_skipped"),
        "year_totals": raw,
        "year_totals_modified": modified,
        "year_totals_diff": differences,
        "index_changes": store.read("index_changes").drop("seq"),
        "change_dates_check": check_change_dates(store),
        "symbol_counts": reports.symbol_counts(store.read("bars")),
    }
    rows = {name: exports.write_report(frame, f"{path}/{name}") for name, frame in frames.items()}
    flags = membership_flags(store, indices, from_year)
    years = sorted(r.year for r in store.read("bars_mod").where(f"year >= {int(from_year)}").select("year").distinct().collect())
    written = exports.write_yearly_flags(flags, f"{path}/flags", years)
    return rows | {f"flags_{year}": n for year, n in written.items()}


def export_prices(store: PriceStore, path, start=None, delta=False) -> None:
    """Raw and adjusted prices as CSV, per year or, for a delta, named by the start date."""
    bars = store.read("bars_mod").drop("year")
    for name, out in (("raw", exports.export_raw(bars, start)), ("adjusted", exports.export_adjusted(bars, start))):
        if delta:
            exports.write_csv_delta(out, f"{path}/{name}", start)
        else:
            exports.write_csv_by_year(out, f"{path}/{name}")


def export_membership(store: PriceStore, path, index_name, start, current=None, codes=None) -> None:
    """Flags of one index as CSV; with `current` as a delta, refused before the last change."""
    if current is None:
        flags = membership_flags(store, [index_name], str(start)[:4])
        exports.write_csv_by_year(exports.export_flags(flags, index_name, start, codes), path)
        return
    snapshots = store.read("snapshots")
    exports.require_no_later_change(snapshots, start)
    out = exports.export_flags_delta(store.read("bars_mod"), snapshots, current, index_name, start, codes)
    exports.write_csv_delta(out, path, start)


def last_stored_day(store: PriceStore):
    """The date a delta run must come after."""
    return ranges.delta_gate(store.read("symbol_range"), "1900-01-01").first().last_dt
