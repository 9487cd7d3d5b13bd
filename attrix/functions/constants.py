"""These must equal the reference's for the same results on
its own customer file, so they are stated here plainly, in natural order."""

# --- fixed values (reference behaviour) ---------------------------------
CONTRACT_RISK = {"Month-to-month": 3, "One year": 2, "Two year": 1}
PAYMENT_RISK = {
    "Electronic check": 3,
    "Mailed check": 2,
    "Bank transfer (automatic)": 1,
    "Credit card (automatic)": 1,
}
UNMAPPED_RISK = 2

TENURE_EDGES = [-1, 12, 24, 48, 1000]
TENURE_LABELS = ["New", "Short", "Medium", "Long"]
TENURE_EDGES_EDA = [-1, 12, 24, 48, 100]
TENURE_LABELS_EDA = ["New (0-12)", "Short (13-24)", "Medium (25-48)", "Long (49+)"]
TENURE_LABELS_PROFILE = ["New", "Short", "Medium", "Long"]
CHARGE_TERCILE_LABELS = ["Low", "Medium", "High"]

SUPPORT_SERVICES = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]

# rate (percent) thresholds -> profile risk level, checked top down with ">"
RISK_LEVELS = [
    (45, "Very High Risk"),
    (35, "High Risk"),
    (25, "Medium-High Risk"),
    (15, "Medium Risk"),
]
LOWEST_RISK_LEVEL = "Low Risk"

# per-customer risk-factor rules of the scoring form
RISK_FACTOR_TEXT = [
    "Month-to-month contract (high churn risk)",
    "Low tenure (new customer risk)",
    "No tech support service",
    "Electronic check payment method",
]
# scoring gauge bands (percent) and the binary decision threshold
GAUGE_BANDS = [(0, 50, "green"), (50, 75, "yellow"), (75, 100, "red")]
HIGH_RISK_ABOVE = 0.5

# interaction pairs (name, first column, second column)
INTERACTION_NAMES = [
    "Contract × Tenure",
    "PaymentMethod × Contract",
    "SeniorCitizen × MonthlyCharges",
    "InternetService × Support_Count",
]
BIVARIATE_PAIRS = [
    ("Contract", "PaymentMethod"),
    ("Contract", "tenure_group"),
    ("InternetService", "TechSupport"),
    ("SeniorCitizen", "Contract"),
    ("PaymentMethod", "tenure_group"),
]
PROFILE_KEYS = ["Contract", "PaymentMethod", "tenure_group", "support_count", "InternetService", "SeniorCitizen"]
KEY_FEATURES = ["Contract", "PaymentMethod", "InternetService", "TechSupport"]

# hyper-parameter spaces of the three searches
LR_C_GRID = [0.001, 0.01, 0.1, 1, 10, 100]
RF_SPACE = {
    "n_estimators": [100, 200, 300],
    "max_depth": [10, 20, 30, None],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2"],
}
GBT_SPACE = {
    "n_estimators": [200, 300, 400, 500, 600],
    "max_depth": [3, 4, 5, 6, 7],
    "learning_rate": [0.01, 0.05, 0.1, 0.15],
    "subsample": [0.8, 0.85, 0.9, 0.95],
    "colsample_bytree": [0.8, 0.85, 0.9, 0.95],
    "min_child_weight": [1, 2, 3],
    "gamma": [0, 0.1, 0.2],
    "reg_alpha": [0, 0.01, 0.1],
    "reg_lambda": [1, 1.5, 2],
}
CV_FOLDS = 5
SEED = 42
RF_SEARCH_ITER = 20
GBT_SEARCH_ITER = 50
GBT_EARLY_STOP_ROUNDS = 10
THRESHOLD_DEFAULT = 0.5
THRESHOLD_MIN_RECALL = 0.75
SIGNIFICANCE = 0.05
