"""The default colour palette."""

# Colour group and the catalogue terms that belong to it. Group
# order and term order decide between several matches.
PALETTE = (
    ("default", (
        "ykl545-btz", "wifi 2+32gb", "style 1", "Retro Telephone", "Pencil Case + Eraser",
        "Multifunctional Vegetable Cutter", "Lick Itself", "Envelope Box",
        "DIY Children's Sewing Fun", "As the Picture0", "As the Picture Shows", "As Pic",
        "3cm Random Color", "30 Pieces", "1810264", "15 Items", "02C 270pcs")),
    ("Yellow", ("yellow grid", "yellow", "Rice Flower 3 Pieces")),
    ("Gold", ("yellow gold", "rose gold", "champagne", "marble/gold")),
    ("Green", (
        "xiuyu jade pagoda", "sage green", "spruce green", "mint green", "dark green",
        "blackish green")),
    ("Brown", (
        "wood color", "dark brown", "light brown", "brown ombre", "ombre", "coffee brown",
        "mocha brown", "espresso", "khaki", "walnut", "havana/pink gradient brown",
        "Black Brown", "Happy Turkey Luxe")),
    ("Pink", (
        "watermelon pink", "hot pink", "pink rabbit box", "coral pink", "Coral", "dusty pink",
        "transparent pink", "strawberry box", "sakura refrigerator mat", "pink+blue",
        "22. Enchantment Coral")),
    ("Grey", (
        "terracotta warriors set", "grey", "gray", "light grey", "dark grey",
        "Dark Grey(3 Seater)", "neutral gray", "charcoal gray", "dimgrey", "gray wood grain",
        "white grey", "Grey Three-petal Flower Earrings")),
    ("Teal", (
        "teal blue", "enchantment coral", "blue-green", "Light Cyan", "Ink-blue Colour")),
    ("Blue", (
        "blue", "sky blue", "baby blue", "denim blue", "steelblue", "navy blue", "royal blue",
        "medium blue", "blue denim", "ink-blue colour", "blue highlight",
        "c2 blue frame/blue lens", "blue and white", "blue and white 6pcs/set",
        "Dark Blue Check", "C4 Black Frame/Gold Lens", "06 Black Blue Frame / 4 Blue Lens")),
    ("Black", (
        "piano color", "solemn black", "natural black", "black2", "black & red",
        "black and white", "rusticbrown/black", "nine-grid sudoku", "Black-58*58cm",
        "Black/ Gray/ White")),
    ("White", (
        "white", "clear", "warm white", "cream color", "beige", "beige+light coffee",
        "transparent", "transparent pink", "3 Pieces Of Purple and White Powder",
        "【Basic Set】Warm White")),
    ("Red", ("red", "rose red", "burgundy", "Red and White", "Red + Champagne")),
    ("Purple", ("purple", "violet purple", "light purple")),
    ("Orange", ("orange", "orange color", "burnt orange", "apricot")),
    ("Multicolor", (
        "multicolor", "multicolor random", "Multicolor Five", "Multi-color", "Multicolor",
        "Jewellery Pop Beads", "Black, White, Red and Yellow", "Color Mixing", "Bright")),
)

# Share of the text length that may be edited, and the group
# that is tried before all others in the approximate step.
EDIT_SHARE = 0.1
FIRST_GROUP = "default"
