"""The patterns, tokens and word lists of the guardrails and grounding checks."""

PROHIBITED_PATTERNS = (
    r"ignore\s+(previous|above|all)\s+instructions",
    r"disregard\s+.*\s+rules",
    r"you\s+are\s+now\s+in\s+developer\s+mode",
    r"pretend\s+you\s+are",
    r"roleplay\s+as",
    r"jailbreak",
    r"sudo\s+mode",
    r"<\s*script\s*>",
    r"DROP\s+TABLE",
    r"DELETE\s+FROM",
)

RISK_PATTERNS = {
    "injection_attack": (r"DROP\s+TABLE", r"DELETE\s+FROM", r"<\s*script\s*>", r";\s*--", r"UNION\s+SELECT"),
    "jailbreak_attempt": (
        r"ignore\s+(previous|all)\s+instructions",
        r"you\s+are\s+now\s+in\s+developer\s+mode",
        r"disable\s+.*\s+safety",
    ),
    "data_exfiltration": (
        r"show\s+me\s+all\s+(patient|user|customer)\s+data",
        r"export\s+.*\s+database",
        r"dump\s+.*\s+table",
    ),
    "sensitive_content": (r"suicide", r"self-harm", r"violence", r"illegal\s+drugs", r"weapons"),
}

RISK_ACTIONS = {
    "injection_attack": ("block",),
    "jailbreak_attempt": ("block",),
    "data_exfiltration": ("block",),
    "pii_exposure": ("mask", "warn"),
    "rate_abuse": ("throttle", "block"),
    "sensitive_content": ("filter", "warn"),
    "token_waste": ("compress", "warn"),
}

# In priority order.
ACTION_NOTES = {
    "block": "Request blocked due to security risk",
    "throttle": "Rate limiting applied",
    "mask": "PII masking applied",
    "filter": "Content filtering applied",
    "compress": "Token compression applied",
    "warn": "Warning logged",
}

PII_A = {
    "EMAIL_ADDRESS": (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "[EMAIL]"),
    "PHONE_NUMBER": (r"\b(?:\+?1[-.]?)?\(?([0-9]{3})\)?[-.]?([0-9]{3})[-.]?([0-9]{4})\b", "[PHONE]"),
    "US_SSN": (r"\b(?!000|666|9\d{2})\d{3}-(?!00)\d{2}-(?!0000)\d{4}\b", "[SSN]"),
    "CREDIT_CARD": (r"\b(?:\d{4}[-\s]?){3}\d{4}\b", "[CREDIT_CARD]"),
    "DATE": (r"\b\d{4}-\d{2}-\d{2}\b|\b\d{1,2}/\d{1,2}/\d{2,4}\b", "[DATE]"),
    "ZIP_CODE": (r"\b\d{5}(?:-\d{4})?\b", "[ZIP]"),
    "PERSON_NAME": (r"\b[A-Z][a-z]+\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?\b", "[PERSON]"),
}

PII_B = {
    "EMAIL_ADDRESS": (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "<EMAIL_REDACTED>"),
    "PHONE_NUMBER": (r"\b(?:\+?1[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)?\d{3}[-.\s]?\d{4}\b", "<PHONE_REDACTED>"),
    "US_SSN": (r"\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b", "<SSN_REDACTED>"),
    "CREDIT_CARD": (r"\b(?:\d{4}[-\s]?){3}\d{4}\b", "<CREDIT_CARD_REDACTED>"),
    "IP_ADDRESS": (r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "<IP_REDACTED>"),
    "DATE": (r"\b(?:\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}[/-]\d{1,2}[/-]\d{1,2})\b", "<DATE_REDACTED>"),
    "PERSON": (r"\b(?:Mr\.|Mrs\.|Ms\.|Dr\.)?\s*[A-Z][a-z]+\s+[A-Z][a-z]+\b", "<PERSON_REDACTED>"),
    "LOCATION": (
        r"\b\d+\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s*,\s*[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s*,?\s*[A-Z]{2}\s*\d{5}(?:-\d{4})?\b",
        "<LOCATION_REDACTED>",
    ),
}
# Profile B ignores case. Names then match any two words, so these two types keep case unless asked.
CASED_TYPES = ("PERSON", "LOCATION")

RESTRICTED = {
    "EXPLICIT_PII": (
        (r"\b\d{3}-\d{2}-\d{4}\b", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"),
        "[REDACTED_PII]",
    ),
    "SENSITIVE_MEDICAL": (
        (r"HIV\s+positive", r"AIDS", r"terminal\s+diagnosis", r"psychiatric\s+disorder", r"substance\s+abuse"),
        "[MEDICAL_CONDITION]",
    ),
    "FINANCIAL_INFO": ((r"\$\d+,?\d*", r"insurance\s+claim\s+#?\d+", r"billing\s+code"), "[FINANCIAL_DATA]"),
}

SIGNAL_STOP = "the a an is are was were what how why when where who".split()
GROUNDING_STOP = (
    "the a an is are was were be been being have has had do does did will would could should may might must shall "
    "to of in for on with at by from as into through during before after and but or nor so yet both either neither "
    "not only own same than too very just"
).split()
REFUSAL = "I don't have enough information"
SAFETY_PHRASES = ("I don't have enough information", "based on the context", "according to", "the policy states")
HEDGING_PHRASES = ("typically", "usually", "generally", "in most cases", "it depends")
