"""Settings, passed explicitly; executors never read the environment."""

from __future__ import annotations

from dataclasses import dataclass, field

#: The file extensions that are admitted.
ALLOWED_EXTENSIONS = (
    ".pdf", ".docx", ".doc", ".xlsx", ".xls", ".xlsm", ".pptx", ".ppt", ".csv", ".txt", ".md", ".markdown", ".json", ".xml", ".png", ".jpg", ".jpeg", ".tiff", ".bmp",
)
#: Formats that go to the local parsers without asking the analyzer, and images.
DIRECT_EXTENSIONS = (".md", ".markdown", ".txt", ".text", ".csv", ".json", ".xml", ".xlsx", ".xls", ".xlsm")
IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".tiff", ".bmp")
#: The local parser of each extension.
LOCAL_PARSERS = {
    "text": (".txt", ".csv", ".log", ".json", ".xml", ".html", ".htm"),
    "markdown": (".md", ".markdown"),
    "docx": (".docx", ".doc"),
    "xlsx": (".xlsx", ".xls", ".xlsm"),
    "pptx": (".pptx", ".ppt"),
    "pdf": (".pdf",),
}
#: Leading path parts that a breadcrumb leaves out.
ROOTS = ("raw-documents", "wiki", "sharepoint", "documents")
#: The label that replaces an entity of each category. Other categories are not redacted.
PII_LABELS = {
    "USSocialSecurityNumber": "[SSN REDACTED]",
    "CreditCardNumber": "[CARD REDACTED]",
    "PhoneNumber": "[PHONE REDACTED]",
    "Email": "[EMAIL REDACTED]",
    "ABARoutingNumber": "[BANK ACCT REDACTED]",
    "USBankAccountNumber": "[BANK ACCT REDACTED]",
    "USDriversLicenseNumber": "[DL REDACTED]",
    "USUKPassportNumber": "[PASSPORT REDACTED]",
    "InternationalBankingAccountNumber": "[BANK ACCT REDACTED]",
    "SWIFTCode": "[BANK ACCT REDACTED]",
    "IPAddress": "[IP REDACTED]",
    "Address": "[LOCATION REDACTED]",
}
#: Entity texts that are never redacted, unless a list of one's own replaces them.
DEFAULT_ALLOWLIST = ("merchant", "customer", "member", "borrower", "vendor", "applicant", "cardholder", "accountholder", "beneficiary", "guarantor", "co-signer")


@dataclass(frozen=True)
class Settings:
    raw_container: str = "raw-documents"
    failed_container: str = "raw-documents-failed"
    max_file_bytes: int = 500 * 1024 * 1024
    # chunks
    chunk_tokens: int = 2000
    overlap_tokens: int = 100
    strategies: dict[str, str] = field(default_factory=lambda: {"markdown": "header_based", "xlsx": "sheet_based", "pdf": "semantic", "default": "recursive"})
    # personal data
    pii_enabled: bool = True
    pii_threshold: float = 0.8
    pii_allowlist: tuple[str, ...] = DEFAULT_ALLOWLIST
    pii_policy: str = "halt"  #: or "proceed"
    pii_breaker: int = 3
    pii_batch: int = 5
    pii_max_chars: int = 5120
    pii_cut_chars: int = 5000
    # embeddings
    dimensions: int = 3072
    embed_batch: int = 16
    embed_batch_tokens: int = 8000
    embed_input_tokens: int = 8191
    # index
    push_batch: int = 100
