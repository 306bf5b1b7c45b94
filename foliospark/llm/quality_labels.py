"""What documents are, as read by a person: ids of the table ``documents`` at scale 0.1, drawn at random from each kind; mixed ones that need counting are left out."""

# fmt: off
_READ = {
    'junk': [543, 1067, 1160, 1761, 2118, 2304, 2713, 3664, 4570, 4831, 4906, 5170, 5448, 5467, 5636, 5746, 5789, 5868, 6072, 6189, 6624, 6821, 7359, 7400, 7538, 7768, 8719, 8754, 8936, 9942],
    'list': [1485, 1573, 1829, 2849, 2914, 3045, 3323, 3442, 3832, 4117, 4159, 4495, 5081, 5549, 5744, 5835, 6204, 6525, 6872, 6904, 6928, 7432, 7672, 8042, 8448, 9381, 9391, 9855],
    'prose': [100, 287, 348, 634, 917, 930, 1108, 1142, 1173, 1186, 1225, 1258, 1566, 1714, 1758, 1822, 1911, 2011, 2189, 2406, 2654, 3462, 3715, 3799, 4060, 4470, 4501, 4576, 5199, 5874, 6067, 6284, 6295, 6592, 6964, 7067, 7410, 7521, 7845, 8596, 8715, 8739, 8780, 9024, 9111, 9205, 9354, 9357],
    'table': [65, 541, 1459, 1604, 2090, 3040, 3365, 3440, 3663, 4545, 4982, 5048, 5433, 6651, 6996, 7357, 7404, 8047, 8380, 8950, 9122, 9540, 9617, 9982],
}
HAND: dict[int, str] = {i: kind for kind, ids in _READ.items() for i in ids}
