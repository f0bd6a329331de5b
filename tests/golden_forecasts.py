"""Monthly units of six series with the forecasts and bands committed for them."""

# name: (units of 2023, units of 2024, forecasts, lower limits, upper limits)
SERIES = {
    "Beauty": (
        [30740, 27301, 31873, 26389, 26805, 26249, 30748, 33486, 34199, 48065, 46149, 41715],
        [31424, 28508, 32081, 26198, 26981, 26358, 29931, 33671, 34224, 48182, 46361, 41727],
        [31323, 28145, 32218], [30876, 27698, 31771], [31770, 28593, 32665],
    ),
    "Clothing": (
        [36221, 31912, 36956, 29997, 30721, 29816, 34823, 38422, 38869, 55445, 51411, 47586],
        [35531, 32364, 37003, 29816, 31064, 30527, 34398, 37854, 38683, 54645, 53767, 46783],
        [35908, 32170, 37012], [35073, 31335, 36177], [36743, 33005, 37846],
    ),
    "Electronics": (
        [11859, 10154, 11913, 9662, 9917, 9747, 11423, 12264, 12915, 18190, 16723, 15642],
        [11535, 10325, 12082, 9575, 9850, 9682, 10965, 12386, 12401, 17637, 17608, 15263],
        [11559, 10102, 11860], [11180, 9722, 11480], [11939, 10482, 12240],
    ),
    "Grocery": (
        [180208, 155061, 182192, 150095, 152370, 149231, 174132, 188595, 194660, 272445, 264820, 236335],
        [178729, 159195, 183250, 147659, 154015, 149760, 169935, 190363, 192162, 271103, 262897, 234378],
        [178656, 156313, 181906], [176430, 154088, 179680], [180881, 158539, 184131],
    ),
    "Home & Kitchen": (
        [17048, 14335, 17027, 14048, 14141, 13775, 16137, 17370, 17910, 25598, 24304, 21963],
        [16669, 14965, 17106, 13686, 14167, 13981, 15788, 17786, 18136, 25101, 24827, 22074],
        [16937, 14729, 17145], [16583, 14375, 16791], [17291, 15083, 17499],
    ),
    "Sports": (
        [17182, 14780, 17287, 14478, 14338, 13956, 16315, 17880, 18504, 25684, 25249, 22816],
        [17059, 15421, 17570, 14414, 14383, 14501, 16230, 18408, 18271, 26203, 25651, 22796],
        [17425, 15405, 17733], [17130, 15110, 17438], [17720, 15700, 18028],
    ),
}
