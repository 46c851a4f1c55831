"""Inline tables shared by the jobs. Fixed values."""

from __future__ import annotations

DEVICES = {1: "Website", 2: "iOS app", 3: "Website", 4: "Android app", 5: "Mobile browser"}
SUBSCRIPTION = {0: "opt-out", 1: "opt-in"}
APP_ORIGINS = [2, 4]
DESKTOP_ORIGINS = [1, 3]
MOBILE_BROWSER_ORIGIN = 5

BILLED_STATES = ["shipping_successful", "delivered"]
FAILED_STATES = [
    "auth_failed", "cancelled", "capture_problems", "fraud", "risk_analysis_expired", "risk_analysis_problems",
]

YES, NO, NOT_AVAILABLE = "Sim", "Não", "n/a"
CREDIT_CARD, BOLETO, DEBIT = "Cartão de Crédito", "Boleto", "Débito Online"
ERP_STATUSES = ["aguardando pagamento", "capturado", "despachado", "pagamento confirmado", "faturado"]
PAYMENT_FAILED = "autorização falhou"
PAYMENT_CAPTURED = "capturado"

RISK_RULES = {
    "Rule 1": "successful_past_order_rule",
    "Rule 2": "maximum_order_value_rule",
    "Rule 3": "maximum_of_purchase_on_period_rule",
}
RISK_RULE_NAMES = {
    "Rule 1": "Successful past order rule",
    "Rule 2": "Maximum order value rule",
    "Rule 3": "Maximum of purchase in period rule",
}
