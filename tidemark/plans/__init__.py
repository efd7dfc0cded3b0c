"""Whole flows made of the operators: training, inference, dashboard."""

from tidemark.plans.dashboard import DashboardColumns, dashboard_panels, publish_dashboard
from tidemark.plans.inference import score_with_champion
from tidemark.plans.training import Home, TrainingResult, train_and_promote

__all__ = [
    "DashboardColumns",
    "Home",
    "TrainingResult",
    "dashboard_panels",
    "publish_dashboard",
    "score_with_champion",
    "train_and_promote",
]
