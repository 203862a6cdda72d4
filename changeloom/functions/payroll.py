"""Insurance and income tax of one payroll row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Insurance share of the base salary, tax-free allowance, and for each bracket its upper edge
# (of the taxable part), rate and quick deduction. The last bracket has no edge.
INSURANCE_RATE = 0.105
ALLOWANCE = 11_000_000
BRACKETS = (
    (5_000_000, 0.05, 0),
    (10_000_000, 0.10, 250_000),
    (18_000_000, 0.15, 750_000),
    (32_000_000, 0.20, 1_650_000),
    (None, 0.25, 3_250_000),
)
FLAT_RATE = 0.05


def insurance(base_salary: Column, rate: float = INSURANCE_RATE) -> Column:
    return base_salary * F.lit(rate)


def progressive_tax(net_salary: Column, allowance: int = ALLOWANCE, brackets=BRACKETS) -> Column:
    """Tax by bracket; NULL net salary stays NULL."""
    taxable = net_salary - F.lit(float(allowance))
    tax = F.when(taxable <= 0, F.lit(0.0))
    for edge, rate, deduction in brackets:
        amount = taxable * F.lit(rate) - F.lit(float(deduction))
        tax = tax.otherwise(amount) if edge is None else tax.when(taxable <= F.lit(float(edge)), amount)
    return tax


def flat_tax(net_salary: Column, allowance: int = ALLOWANCE, rate: float = FLAT_RATE) -> Column:
    """One rate above the allowance; NULL net salary gives 0.0."""
    threshold = F.lit(float(allowance))
    return F.when(net_salary > threshold, (net_salary - threshold) * F.lit(rate)).otherwise(F.lit(0.0))


def take_home(net_salary: Column, insurance_amt: Column, tax_amount: Column) -> Column:
    return net_salary - insurance_amt - tax_amount
