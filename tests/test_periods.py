from datetime import date

import pytest

from ledgerflow import Period


def test_defaults():
    today = date(2026, 2, 17)
    assert Period.of(today=today) == Period(date(2026, 2, 1), date(2026, 2, 28))
    assert Period.of(today=today, end_default="today").end == today
    assert Period.of(" ", "", today=today).start == date(2026, 2, 1)
    assert Period.of("2026-01-05", "2026-01-20") == Period(date(2026, 1, 5), date(2026, 1, 20))


def test_run_month_and_previous_month():
    assert Period.month_of(date(2026, 1, 1)) == Period(date(2026, 1, 1), date(2026, 1, 31))
    assert Period.month_of(date(2024, 2, 1)).end == date(2024, 2, 29)
    assert Period.month_of(date(2026, 1, 1)).end_exclusive == date(2026, 2, 1)
    assert Period.previous_month(date(2026, 1, 15)) == Period(date(2025, 12, 1), date(2025, 12, 31))


def test_generator_bounds():
    assert Period.from_generator_args("2026-01-01", "2027-01-01").end == date(2026, 12, 31)
    with pytest.raises(ValueError):
        Period.from_generator_args("2026-01-01", None)
    assert Period.from_generator_args(today=date(2026, 3, 3)).start == date(2026, 2, 1)


def test_months_in_order():
    p = Period(date(2025, 11, 15), date(2026, 2, 3))
    assert [m.start for m in p.months()] == [date(2025, 11, 1), date(2025, 12, 1),
                                             date(2026, 1, 1), date(2026, 2, 1)]
    with pytest.raises(ValueError):
        Period(date(2026, 2, 1), date(2026, 1, 1))
