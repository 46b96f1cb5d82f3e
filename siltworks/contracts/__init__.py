from siltworks.contracts.declared import (
    DECLARED,
    catalog_contracts,
    declared,
    read_contracts,
)
from siltworks.contracts.model import Contract, ForeignKey, Registry

__all__ = [
    "DECLARED",
    "Contract",
    "ForeignKey",
    "Registry",
    "catalog_contracts",
    "declared",
    "read_contracts",
]
