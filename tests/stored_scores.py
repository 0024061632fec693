"""Stored scores of 42 held-out signals and the figures published for them (fixed values)."""

Y = [1, 1, 1, 1, 0, 0, 0, 1, 0, 0, 1, 0, 1, 1, 1, 1, 0, 0, 1, 0, 0,
     1, 0, 1, 1, 1, 1, 0, 1, 1, 1, 0, 1, 0, 1, 0, 0, 0, 0, 0, 0, 1]

SVM = [
    0.43866896173712716, 0.5288592363457225, 0.9242117429897447, 0.9923497639992709, 0.08699688126094955,
    0.696347829908531, 0.059940026192432584, 0.9872913200237436, 0.01741220589859267, 0.025464256833866928,
    0.8184517706613081, 0.050877127304047864, 0.46259355912674394, 0.5708130389593388, 0.8745926783125268,
    0.833271138332894, 0.2693231731378259, 0.5086471090555464, 0.9635435149181456, 0.42250758131628546,
    0.06617965371396269, 0.8442690313533734, 0.05346429924692985, 0.8502064093229534, 0.8611367406567395,
    0.9701015864236336, 0.9279127819686398, 0.11391670473455018, 0.9030660384347098, 0.8883983102773184,
    0.5654921003841379, 0.037826175705408874, 0.9798042470101239, 0.6852576466938209, 0.8569624944767983,
    0.009614223523460733, 0.2445585734122445, 0.041754377909164885, 0.351753177248607, 0.008010007869069432,
    0.0023757002334837286, 0.9343823234024985,
]
SVM_HARD = [1, 1, 1, 1, 0, 1, 0, 1, 0, 0, 1, 0, 1, 1, 1, 1, 0, 1, 1, 0, 0,
            1, 0, 1, 1, 1, 1, 0, 1, 1, 1, 0, 1, 1, 1, 0, 0, 0, 0, 0, 0, 1]

FOREST = [0.48, 0.58, 0.71, 0.92, 0.3, 0.57, 0.35, 0.97, 0.08, 0.14, 0.53, 0.33, 0.63, 0.45, 0.77, 0.67, 0.51, 0.46,
          0.75, 0.52, 0.19, 0.59, 0.14, 0.69, 0.59, 0.76, 0.86, 0.35, 0.83, 0.75, 0.49, 0.11, 0.93, 0.61, 0.77, 0.18,
          0.5, 0.16, 0.59, 0.1, 0.07, 0.78]
FOREST_HARD = [0, 1, 1, 1, 0, 1, 0, 1, 0, 0, 1, 0, 1, 0, 1, 1, 1, 0, 1, 1, 0,
               1, 0, 1, 1, 1, 1, 0, 1, 1, 0, 0, 1, 1, 1, 0, 0, 0, 1, 0, 0, 1]

SVM_AUC, SVM_BRIER = 0.9727272727272727, 0.073518496921242
FOREST_AUC = 0.9386363636363637

# tau: tp, fp, tn, fn, accuracy, precision, recall, f1
SVM_AT = {
    0.50: (20, 3, 17, 2, 0.8809523809523809, 0.8695652173913043, 0.9090909090909091, 0.8888888888888888),
    0.43: (22, 3, 17, 0, 0.9285714285714286, 0.88, 1.0, 0.9361702127659575),
}
SVM_HARD_COUNTS = (22, 3, 17, 0)
FOREST_HARD_COUNTS = (19, 5, 15, 3)

SVM_ROC = [(0.0, 0.0), (0.0, 1 / 22), (0.0, 17 / 22), (0.1, 17 / 22), (0.1, 20 / 22), (0.15, 20 / 22), (0.15, 1.0),
           (1.0, 1.0)]
FOREST_ROC_POINTS = 20

# threshold: accuracy, precision, recall, f1, tp, fp, tn, fn, cost
SVM_SWEEP = {
    0.01: (0.5952, 0.5641, 1.0, 0.7213, 22, 17, 3, 0, 17.0),
    0.20: (0.8333, 0.7586, 1.0, 0.8627, 22, 7, 13, 0, 7.0),
    0.43: (0.9286, 0.88, 1.0, 0.9362, 22, 3, 17, 0, 3.0),
    0.50: (0.881, 0.8696, 0.9091, 0.8889, 20, 3, 17, 2, 13.0),
    0.99: (0.5, 1.0, 0.0455, 0.087, 1, 0, 20, 21, 105.0),
}
SVM_POINTS = {"default": 0.50, "max_f1": 0.43, "high_recall_safe": 0.43, "cost_optimal": 0.43}

SVM_ERRORS = {5: 0.26634782990853095, 17: 0.07864710905554645, 33: 0.25525764669382095}

# class: precision, recall, f1, support (hard labels of the forest)
FOREST_REPORT = {
    "Rock (0)": (0.8333333333333334, 0.75, 0.7894736842105263, 20),
    "Mine (1)": (0.7916666666666666, 0.8636363636363636, 0.8260869565217391, 22),
    "macro avg": (0.8125, 0.8068181818181819, 0.8077803203661327, 42),
    "weighted avg": (0.8115079365079364, 0.8095238095238095, 0.8086520649449711, 42),
}

# model: baseline f1 and accuracy, tuned f1 and accuracy, published gains
TUNING = {
    "Support Vector Machine": (0.9362, 0.9286, 0.9362, 0.9286, 0.0, 0.0),
    "Random Forest": (0.8261, 0.8095, 0.875, 0.8571, 0.0489, 0.0476),
    "K-Nearest Neighbors": (0.8085, 0.7857, 0.875, 0.8571, 0.0665, 0.0714),
    "Logistic Regression": (0.8444, 0.8333, 0.7907, 0.7857, -0.0537, -0.0476),
}
TUNED_RECALL = {"Support Vector Machine": 1.0, "Random Forest": 0.9545, "K-Nearest Neighbors": 0.9545,
                "Logistic Regression": 0.7727}
CLASS_SIZES, SPLIT_SIZES = {1: 111, 0: 97}, {"train": {1: 89, 0: 77}, "test": {1: 22, 0: 20}}
