"""starrung: ratings analytics on Spark DataFrames.

Exploration, feature extraction, exact stratified splits and an additive
ladder of grouped-mean effects, all as Catalyst plans without Python UDFs.
"""

from starrung.plans.ladder import EffectLadder, LadderModel
from starrung.plans.study import Study
from starrung.workspace import Workspace

__all__ = ["EffectLadder", "LadderModel", "Study", "Workspace"]
