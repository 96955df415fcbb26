"""Chemistry kernels behind a provider, so that everything else runs without a toolkit.

No toolkit is bundled. `provider()` gives RDKit's kernels where it can be imported and raises a clear
error elsewhere; nothing is simulated. Each kernel becomes an Arrow-batched function over a column.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Chemistry(Protocol):
    def canonical(self, smiles: str) -> str | None: ...
    def properties(self, smiles: str) -> dict[str, float] | None: ...
    def matches(self, smiles: str, pattern: str) -> bool | None: ...
    def scaffold(self, smiles: str) -> str | None: ...


class Missing(RuntimeError):
    """No chemistry toolkit is installed."""


class RDKit:
    """The kernels by RDKit; unparsable structures give None."""

    def __init__(self):
        from rdkit import Chem
        from rdkit.Chem import Crippen, Descriptors, QED, rdMolDescriptors
        from rdkit.Chem.Scaffolds import MurckoScaffold

        self.chem, self.murcko = Chem, MurckoScaffold
        self.descriptors = {
            "MW": Descriptors.MolWt, "logP": Crippen.MolLogP, "TPSA": rdMolDescriptors.CalcTPSA, "QED": QED.qed, "MR": Crippen.MolMR,
            "HBD": rdMolDescriptors.CalcNumHBD, "HBA": rdMolDescriptors.CalcNumHBA, "rotB": rdMolDescriptors.CalcNumRotatableBonds,
            "rings_total": rdMolDescriptors.CalcNumRings, "heavy_atoms": lambda m: m.GetNumHeavyAtoms(),
        }

    def _mol(self, smiles: str | None):
        return self.chem.MolFromSmiles(smiles) if smiles else None

    def canonical(self, smiles: str) -> str | None:
        mol = self._mol(smiles)
        return self.chem.MolToSmiles(mol, isomericSmiles=False) if mol else None

    def properties(self, smiles: str) -> dict[str, float] | None:
        mol = self._mol(smiles)
        return {k: round(float(f(mol)), 3) for k, f in self.descriptors.items()} if mol else None

    def matches(self, smiles: str, pattern: str) -> bool | None:
        mol, wanted = self._mol(smiles), self.chem.MolFromSmarts(pattern)
        return mol.HasSubstructMatch(wanted) if mol and wanted else None

    def scaffold(self, smiles: str) -> str | None:
        mol = self._mol(smiles)
        return self.chem.MolToSmiles(self.murcko.GetScaffoldForMol(mol)) if mol else None


def provider() -> Chemistry:
    try:
        return RDKit()
    except ImportError as absent:
        raise Missing("chemistry kernels need RDKit, which is not installed") from absent


def kernel(name: str, returns: str, *args: str) -> Callable[[Column], Column]:
    """A provider's method as a column function; the toolkit is loaded once a worker, not once a row."""
    provider()  # fail on the driver, not in a task

    @F.pandas_udf(returns)
    def run(values: pd.Series) -> pd.Series:
        call = getattr(provider(), name)
        return values.map(lambda v: call(v, *args), na_action="ignore")

    return run
